"""Date formats: naming the format of a cell and reading it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DATE_SHAPES, ENGLISH_MONTH_NAMES, ENGLISH_MONTHS, ITALIAN_MONTH_NAMES, ITALIAN_MONTHS
from plumbline.functions.text import ref, strip

_MONTH_NUMBERS = {
    name: f"{number:02d}"
    for names in (ITALIAN_MONTHS, ENGLISH_MONTHS, ITALIAN_MONTH_NAMES, ENGLISH_MONTH_NAMES)
    for number, name in enumerate(names, start=1)
}


_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_SEEN = 40  # every format is told by fewer characters


def picture(text: Column) -> Column:
    """The beginning of the cell with every digit as 9, capital as A and small letter as a.

    Comparing pictures replaces a dozen regular expressions per cell. Formats that let anything follow need the
    beginning only; the others are shorter than a picture, so a cut cell never equals one.
    """
    return F.translate(F.substring(text, 1, _SEEN), _UPPER + _LOWER + _DIGITS, "A" * 26 + "a" * 26 + "9" * 10)


def _matches(text: Column, seen: Column, wanted: str) -> Column:
    body = wanted.rstrip("*")
    mask = "".join("A" if ch.isupper() else ch for ch in body)
    hit = seen.startswith(mask) if wanted.endswith("*") else seen == mask
    for position, ch in enumerate(body, start=1):
        if ch.isupper() and ch != "A":
            hit = hit & (F.substring(text, position, 1) == ch)
    return hit


def shape(text: Column, seen: Column, shapes: Sequence[tuple[str, str]] = DATE_SHAPES) -> Column:
    """Name of the first matching date format of a trimmed cell with its ``picture``, else ``other``."""
    chain = None
    for name, wanted in shapes:
        hit = _matches(text, seen, wanted)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain.otherwise("other")


def _month(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in _MONTH_NUMBERS.items() for x in pair])
    return F.try_element_at(table, F.upper(name))


def _ymd(year: Column, month: Column, day: Column) -> Column:
    return F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date")


def _century(two_digits: Column) -> Column:
    """00-68 are 2000s, 69-99 are 1900s."""
    return F.concat(F.when(two_digits <= "68", "20").otherwise("19"), two_digits)


def _worded(*pictures: str) -> tuple[str, ...]:
    """Pictures with a month name of three to nine letters for ``M``, and the day in one or two digits for ``D``."""
    return tuple(p.replace("M", "A" * n).replace("D", d) for p in pictures for n in range(3, 10) for d in ("99", "9"))


def _loose(order: str, mark: str, year: str = "9999") -> tuple[str, ...]:
    """Pictures of a numeric date whose day or month has one digit, or that a time of day follows."""
    out = []
    for a in ("99", "9"):
        for b in ("99", "9"):
            parts = (a, b, year) if order == "dmy" else (year, a, b)
            plain = mark.join(parts)
            out += ([] if a == b == "99" else [plain]) + [f"{plain} 99:99*", f"{plain} 9:99*"]
    return tuple(out)


# What ``with_dates`` can read, by the picture of the cell with all letters as A.
_LAYOUTS = (
    ("ISO-8601 datetime", ("9999-99-99A99*", "9999-99-99 99*")),
    ("YYYY-MM-DD", ("9999-99-99",)),
    ("YYYY/MM/DD", ("9999/99/99",)),
    ("DD/MM/YYYY", ("99/99/9999",)),
    ("DD.MM.YYYY", ("99.99.9999",)),
    ("DD-MM-YYYY", ("99-99-9999",)),
    ("DD-MM-YY", ("99-99-99",)),
    ("YYYY-MM", ("9999-99",)),
    ("MM/YYYY", ("99/9999",)),
    ("MON DD YYYY", _worded("M D 9999", "M D, 9999")),
    ("DD MON YYYY", _worded("D M 9999", "D-M-9999")),
    ("MON-YYYY", _worded("M-9999", "M 9999")),
    ("D/M/YYYY", _loose("dmy", "/") + _loose("dmy", ".") + _loose("dmy", "-")),
    ("YYYY-M-D", tuple(p for p in _loose("ymd", "-") if not p.startswith("9999-99-99 ")) + _loose("ymd", "/")),
)
LAYOUT_NAMES = tuple(name for name, _ in _LAYOUTS)


def layout(seen: Column) -> Column:
    """Name of the layout behind the ``picture`` of a trimmed cell, null where it resembles no date.

    A bare six-digit YYYYMM code is a number, not a date.
    """
    seen = F.upper(seen)
    # Whole pictures and, by length, beginnings after which anything may follow: no picture fits two layouts. Look-ups
    # instead of a chain of comparisons, so that the method generated for a row stays small enough to be compiled.
    known: dict[int, dict[str, str]] = {0: {}}
    for name, wanted in _LAYOUTS:
        for w in wanted:
            length = len(w) - 1 if w.endswith("*") else 0
            known.setdefault(length, {}).setdefault(w.rstrip("*"), name)
    found = []
    for length, names in sorted(known.items()):
        table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
        piece = F.substring(seen, 1, length) if length else seen
        # A map is searched key by key, a list by hash: most cells leave here.
        found.append(F.when(piece.isin(*names), F.try_element_at(table, piece)))
    return F.coalesce(*found)


_DAY_FIRST = ("DD/MM/YYYY", "DD.MM.YYYY", "DD-MM-YYYY", "DD-MM-YY", "D/M/YYYY")
_YEAR_FIRST = ("YYYY-MM-DD", "YYYY/MM/DD", "YYYY-MM", "YYYY-M-D")
_STAMP = "ISO-8601 datetime"
_WORDED = ("MON DD YYYY", "DD MON YYYY", "MON-YYYY")
_NO_DAY = ("YYYY-MM", "MM/YYYY", "MON-YYYY")


def _numbers(text: Column, name: Column) -> Column:
    """The numbers of a cell whose layout has three of them or two."""
    return F.when(name.isNotNull() & ~name.isin(_STAMP, *_WORDED), F.split(text, "[^0-9]+"))


def _parts(text: Column, name: Column, numbers: Column) -> Column:
    """[year, month, day] of a trimmed cell, the day before the month where the order is open."""

    def number(i: int) -> Column:
        return F.get(numbers, F.lit(i))

    def two(i: int) -> Column:
        return F.lpad(number(i), 2, "0")

    year = (
        F.when(name.isin(*_YEAR_FIRST), number(0))
        .when(name == "DD-MM-YY", _century(number(2)))
        .otherwise(F.coalesce(number(2), F.right(text, F.lit(4))))
    )
    month = (
        F.when(name.isin(*_WORDED), _month(F.regexp_extract(text, "([A-Za-z]{3,})", 1)))
        .when(name == "MM/YYYY", two(0))
        .otherwise(two(1))
    )
    day = (
        F.when(name.isin(*_NO_DAY), "01")
        .when(name.isin(*_WORDED), F.lpad(F.regexp_extract(text, r"\b(\d{1,2})\b", 1), 2, "0"))
        .when(name.isin(*_YEAR_FIRST), two(2))
        .otherwise(two(0))
    )
    return F.when(name != _STAMP, F.array(year, month, day))


def _date(text: Column, name: Column, parts: Column) -> Column:
    year, month, day = (F.get(parts, F.lit(i)) for i in range(3))
    stamp = F.coalesce(text.try_cast("timestamp").cast("date"), F.substring(text, 1, 10).try_cast("date"))
    other = F.when(name.isin(*_DAY_FIRST), _ymd(year, day, month))
    return F.when(name == _STAMP, stamp).otherwise(F.coalesce(_ymd(year, month, day), other))


def with_read(df: DataFrame, text: str, name: str, out: str) -> DataFrame:
    """Add ``out``, the date of the trimmed cells ``text`` with the layouts ``name``; null where the digits are no date.

    The day comes before the month; month first only where day first is no date. Numbers, then year, month and day are
    picked by layout, each once a row, and read once: a reader for each layout is more code than the JVM compiles.
    """
    text_, name_ = ref(text), ref(name)
    steps = df.withColumn(f"__numbers {out}", _numbers(text_, name_))
    steps = steps.withColumn(f"__parts {out}", _parts(text_, name_, ref(f"__numbers {out}")))
    return steps.withColumn(out, _date(text_, name_, ref(f"__parts {out}"))).drop(f"__numbers {out}", f"__parts {out}")


def with_dates(df: DataFrame, source: str = "value") -> DataFrame:
    """Add ``text`` (the trimmed cell), ``picture``, ``layout`` and ``date``, each computed once per row. Cells without
    the marks that every layout has get no picture."""
    named = (
        df.withColumn("text", strip(F.col(source)))
        .withColumn("picture", F.when(F.col("text").rlike("[-/. ]"), picture(F.col("text"))))
        .withColumn("layout", layout(F.col("picture")))
    )
    return with_read(named, "text", "layout", "date")


def period(t: Column) -> Column:
    """YYYYMM text of a trimmed cell written as YYYY-MM, MM/YYYY, MON-YYYY or YYYYMM; null for anything else."""
    month = r"(0[1-9]|1[0-2])"
    mon_yyyy = r"^([A-Za-z]{3})-(\d{4})$"
    return (
        F.when(t.rlike(rf"^\d{{4}}{month}$"), t)
        .when(t.rlike(rf"^\d{{4}}-{month}$"), F.concat(F.substring(t, 1, 4), F.substring(t, 6, 2)))
        .when(t.rlike(rf"^{month}/\d{{4}}$"), F.concat(F.substring(t, 4, 4), F.substring(t, 1, 2)))
        .when(
            t.rlike(mon_yyyy),
            F.concat(F.regexp_extract(t, mon_yyyy, 2), _month(F.regexp_extract(t, mon_yyyy, 1))),
        )
    )


def is_period(x: Column) -> Column:
    """True for a number that reads as YYYYMM with year 1900-2100 and month 1-12."""
    n = x.try_cast("long")
    return n.between(190001, 210012) & (n % 100).between(1, 12)
