"""For each query the SQL that computes the same rows in another engine, written from the definition of the check."""

from __future__ import annotations

from collections.abc import Sequence

from plumbline.config import AMOUNT_KEYWORDS, INVALID_MARKERS, ITALIAN_MONTHS, NA_STRINGS, PLACEHOLDER_WORDS, PLACEHOLDERS, YEAR_WORDS
from plumbline.plans.dirty_orders import COLUMNS

# --- building blocks ---------------------------------------------------------


def _list(words: Sequence[str]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _id(name: str) -> str:
    return '"' + name + '"'


def num(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?0*[12]?\\d?\\d)?\\s*$') "
        f"THEN TRY_CAST({x} AS DOUBLE) END"
    )


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def missing(x: str) -> str:
    return f"({x} IS NULL OR {x} IN {_list(PLACEHOLDERS)})"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return f"round_even(({part}) * 100.0 / ({whole}), {digits})"


_MON = "CASE month(o_orderdate) " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(ITALIAN_MONTHS, 1)) + " END"
_LBL = "CASE o_orderstatus WHEN 'F' THEN 'Finito' WHEN 'O' THEN 'Aperto' ELSE 'Parziale' END"
_AMT = "CAST(CAST(floor(o_totalprice/50)*50 + 0.25 AS DECIMAL(18,2)) AS VARCHAR)"
_SPEND = (
    f"CASE WHEN k%89=0 THEN 'N.D.' WHEN k%83=0 THEN '€'||{_AMT} WHEN k%503=0 THEN '-'||{_AMT} "
    f"WHEN k%79=0 THEN NULL ELSE {_AMT} END"
)


def _day(fmt: str) -> str:
    return f"strftime(o_orderdate, '{fmt}')"


DIRTY = f"""
src AS (SELECT *, o_orderkey AS k, unnest(CASE WHEN o_orderkey%97=0 THEN [1,2] ELSE [1] END) AS copy FROM orders),
dirty AS (SELECT
  'ord'||k AS "_id",
  CASE WHEN k%37=0 THEN {_day('%Y-%m')} WHEN k%41=0 THEN {_MON}||'-'||{_day('%Y')} ELSE {_day('%Y%m')} END AS rata,
  CAST(CASE WHEN k%43=0 THEN year(o_orderdate)%100 WHEN k%53=0 THEN year(o_orderdate)+1 ELSE year(o_orderdate) END AS VARCHAR) AS anno,
  CAST(CASE WHEN k%211=0 THEN -1 WHEN k%47=0 THEN month(o_orderdate)%12+1 ELSE month(o_orderdate) END AS VARCHAR) AS mese,
  {_SPEND} AS spesa,
  {_SPEND} AS "SPESA TOTALE",
  CASE WHEN k%31=0 THEN {_day('%d/%m/%Y')} WHEN k%29=0 THEN {_day('%d.%m.%Y')} WHEN k%61=0 THEN {_day('%d-%m-%y')}
       WHEN k%67=0 THEN {_day('%Y/%m/%d')} WHEN k%71=0 THEN {_MON}||' '||{_day('%d %Y')}
       ELSE {_day('%Y-%m-%d')}||'T00:00:00' END AS "aggregation-time",
  CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END AS cod_stato,
  CASE WHEN k%997=0 THEN 'Da definire' WHEN k%19=0 THEN lower(o_orderpriority) WHEN k%59=0 THEN o_orderpriority||' '
       ELSE o_orderpriority END AS priorita,
  CASE WHEN k%101=0 THEN 'unknown' WHEN k%997=0 THEN 'Da definire' WHEN k%23=0 THEN lower({_LBL}) WHEN k%17=0 THEN upper({_LBL})
       ELSE {_LBL} END AS stato,
  CASE WHEN k%5=0 THEN NULL WHEN k%103=0 THEN 'n.d.' ELSE 'area'||(o_custkey%7) END AS area_geografica,
  CASE WHEN k%73=0 THEN 'verificare' END AS note,
  CASE WHEN k%3=0 THEN {_AMT}||'0000000003' ELSE {_AMT} END AS quota,
  CASE WHEN k%107=0 THEN 'Sistema legacy' END AS fonte_dato
  FROM src)"""


def _cells(source: str, columns: Sequence[str]) -> str:
    names = ", ".join("'" + c + "'" for c in columns)
    values = ", ".join(_id(c) for c in columns)
    places = ", ".join(str(i) for i in range(len(columns)))
    return f"""cells AS (SELECT unnest([{names}]) AS "column", unnest([{values}]) AS value, unnest([{places}]) AS ordinal FROM {source})"""


CELLS = _cells("dirty", COLUMNS)
WITH = f"WITH {DIRTY}, {CELLS}"
_LINE = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


def _text_of(table: str, columns: Sequence[str], doubles: Sequence[str]) -> str:
    parts = [
        f"CAST(CAST({c} AS DECIMAL(38,2)) AS VARCHAR) AS {c}" if c in doubles else f"CAST({c} AS VARCHAR) AS {c}"
        for c in columns
    ]
    return f"src AS (SELECT {', '.join(parts)} FROM {table})"


LINE_TEXT = _text_of("lineitem", _LINE, ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))

# Dates: the layout of a trimmed cell by regular expression, then strptime.
_DATES = (
    ("ISO-8601 datetime", r"^\d{4}-\d{2}-\d{2}[A-Za-z ]\d{2}", "CAST(TRY_CAST({t} AS TIMESTAMP) AS DATE)"),
    ("YYYY-MM-DD", r"^\d{4}-\d{2}-\d{2}$", "CAST(try_strptime({t}, '%Y-%m-%d') AS DATE)"),
    ("YYYY/MM/DD", r"^\d{4}/\d{2}/\d{2}$", "CAST(try_strptime({t}, '%Y/%m/%d') AS DATE)"),
    ("DD/MM/YYYY", r"^\d{2}/\d{2}/\d{4}$", "CAST(try_strptime({t}, ['%d/%m/%Y', '%m/%d/%Y']) AS DATE)"),
    ("DD.MM.YYYY", r"^\d{2}\.\d{2}\.\d{4}$", "CAST(try_strptime({t}, ['%d.%m.%Y', '%m.%d.%Y']) AS DATE)"),
    ("DD-MM-YYYY", r"^\d{2}-\d{2}-\d{4}$", "CAST(try_strptime({t}, ['%d-%m-%Y', '%m-%d-%Y']) AS DATE)"),
    ("DD-MM-YY", r"^\d{2}-\d{2}-\d{2}$", "CAST(try_strptime({t}, ['%d-%m-%y', '%m-%d-%y']) AS DATE)"),
    ("YYYY-MM", r"^\d{4}-\d{2}$", "CAST(try_strptime({t}||'-01', '%Y-%m-%d') AS DATE)"),
    ("MM/YYYY", r"^\d{2}/\d{4}$", "CAST(try_strptime('01/'||{t}, '%d/%m/%Y') AS DATE)"),
    ("MON DD YYYY", r"^[A-Za-z]{3} \d{1,2},? \d{4}$", "CAST(try_strptime(replace({e}, ',', ''), '%b %d %Y') AS DATE)"),
    ("DD MON YYYY", r"^\d{1,2}[ -][A-Za-z]{3}[ -]\d{4}$", "CAST(try_strptime(replace({e}, '-', ' '), '%d %b %Y') AS DATE)"),
    ("MON-YYYY", r"^[A-Za-z]{3}[ -]\d{4}$", "CAST(try_strptime('01 '||replace({e}, '-', ' '), '%d %b %Y') AS DATE)"),
)


def _english(t: str) -> str:
    out = t
    for it, en in (("GEN", "Jan"), ("MAG", "May"), ("GIU", "Jun"), ("LUG", "Jul"), ("AGO", "Aug"), ("SET", "Sep"), ("OTT", "Oct"), ("DIC", "Dec")):
        out = f"regexp_replace({out}, '(?i)\\b{it}\\b', '{en}', 'g')"
    return out


def layout(t: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({t}, '{p}') THEN '{n}'" for n, p, _ in _DATES) + " END"


def date_of(t: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({t}, '{p}') THEN {r.format(t=t, e=_english(t))}" for _, p, r in _DATES)
    return f"CASE {whens} END"


_SHAPES = (
    ("ISO-8601 datetime", r"^\d{4}-\d{2}-\d{2}T"),
    ("YYYY-MM-DD", r"^\d{4}-\d{2}-\d{2}$"),
    ("YYYY/MM/DD", r"^\d{4}/\d{2}/\d{2}$"),
    ("DD/MM/YYYY", r"^\d{2}/\d{2}/\d{4}$"),
    ("DD.MM.YYYY", r"^\d{2}\.\d{2}\.\d{4}$"),
    ("DD-MM-YY", r"^\d{2}-\d{2}-\d{2}$"),
    ("YYYYMM", r"^\d{6}$"),
    ("YYYY-MM", r"^\d{4}-\d{2}$"),
    ("MM/YYYY", r"^\d{2}/\d{4}$"),
    ("MON-YYYY", r"^[A-Z]{3}-\d{4}$"),
)
_SHAPE = "CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in _SHAPES) + " ELSE 'other' END"


def _profile(ctes: str, columns: Sequence[str]) -> str:
    return f"""WITH {ctes},
vf AS (SELECT "column", ordinal, value, count(*) AS cnt, {num('value')} AS x, {strip('value')} AS t FROM cells GROUP BY 1, 2, 3),
dated AS (SELECT *, {layout('t')} AS lay, {date_of('t')} AS d FROM vf),
best AS (SELECT "column", max(n) AS dates FROM (SELECT "column", lay, sum(cnt) AS n FROM dated WHERE d IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
f AS (SELECT "column", any_value(ordinal) AS ordinal, sum(cnt) AS row_count, coalesce(sum(cnt) FILTER (value IS NOT NULL), 0) AS filled,
  count(value) AS cardinality, coalesce(sum(cnt) FILTER (x IS NOT NULL), 0) AS numbers,
  coalesce(bool_and(lower(value) IN ('true','false','yes','no','1','0','t','f','y','n')), false) AS bools,
  sum(cnt * length(value)) AS chars FROM dated GROUP BY 1),
s AS (SELECT "column", string_agg(value, '|' ORDER BY cnt DESC, value) AS sample_values FROM
  (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY cnt DESC, value) AS rn FROM vf WHERE value IS NOT NULL) WHERE rn <= 5 GROUP BY 1),
p AS (SELECT f."column", CAST(ordinal AS INT) AS ordinal, 'string' AS dtype, CAST(row_count AS BIGINT) AS row_count,
  CAST(row_count - filled AS BIGINT) AS null_count, {pct('row_count - filled', 'row_count')} AS null_pct, cardinality,
  round_even(cardinality / row_count, 4) AS cardinality_ratio, round_even(numbers / filled, 4) AS numeric_ratio,
  round_even(coalesce(dates, 0) / filled, 4) AS date_ratio, round_even(chars / filled, 4) AS avg_length,
  numbers / filled AS nr, coalesce(dates, 0) / filled AS dr, filled, bools, coalesce(sample_values, '') AS sample_values
  FROM f LEFT JOIN best USING ("column") LEFT JOIN s USING ("column")),
profile AS (SELECT "column", ordinal, dtype,
  CASE WHEN filled = 0 THEN 'text' WHEN cardinality <= 3 AND bools THEN 'boolean'
       WHEN cardinality_ratio > 0.95 AND cardinality > 10 THEN 'identifier' WHEN nr >= 0.9 THEN 'numeric'
       WHEN dr >= 0.7 THEN 'date' WHEN cardinality_ratio < 0.05 THEN 'categorical' ELSE 'text' END AS semantic_type,
  row_count, null_count, null_pct, cardinality, cardinality_ratio, numeric_ratio, date_ratio, avg_length, sample_values FROM p)
"""


PROFILE = _profile(f"{DIRTY}, {CELLS}", COLUMNS)


def _listed(condition: str) -> str:
    return f"""coalesce(string_agg("column", '|' ORDER BY ordinal) FILTER ({condition}), '')"""


SUMMARY = PROFILE + f""", summary AS (SELECT count(*) AS total_columns, max(row_count) AS total_rows,
  round_even(avg(100 - null_pct) / 100, 4) AS overall_completeness, round_even(avg(100 - null_pct), 2) AS overall_completeness_pct,
  {_listed("semantic_type = 'numeric'")} AS numeric_columns,
  {_listed("semantic_type IN ('categorical', 'text', 'identifier', 'boolean')")} AS categorical_columns,
  {_listed("semantic_type = 'date'")} AS date_columns,
  {_listed("null_pct > 20")} AS high_missing_columns,
  {_listed("null_pct > 95")} AS ultra_sparse_columns,
  {_listed("cardinality_ratio > 0.95")} AS possible_identifier_columns FROM profile)"""

_MISS = f"""{WITH}, m AS (SELECT "column", CAST(any_value(ordinal) AS INT) AS ordinal, count(*) AS row_count,
  count_if({missing('value')}) AS null_count FROM cells GROUP BY 1)"""
_SEVERITY = "CASE WHEN {r} >= 95 THEN 'CRITICAL' WHEN {r} >= 20 THEN 'HIGH' WHEN {r} >= 5 THEN 'MODERATE' ELSE 'LOW' END"
_CONTAMINATION = "CASE WHEN bad_pct > 10 THEN 'CRITICAL' WHEN bad_pct >= 1 THEN 'MODERATE' ELSE 'MINOR' END"


def _table(replace: dict[str, str], drop: Sequence[str] = (), columns: Sequence[str] = COLUMNS) -> str:
    """The dirty table with some columns replaced or dropped."""
    items = [f"{replace[c]} AS {_id(c)}" if c in replace else _id(c) for c in columns if c not in drop]
    return "SELECT " + ", ".join(items) + " FROM dirty"


_CLEAR = {c: f"CASE WHEN {_id(c)} NOT IN {_list(PLACEHOLDERS)} THEN {_id(c)} END" for c in COLUMNS}


def _stripped_money(c: str) -> str:
    inner = strip(f"regexp_replace({c}, '€|EUR|�|\\$|£|¥|%', '', 'g')")
    return num(inner)


def _money_text(c: str) -> str:
    return f"CAST(CAST({_stripped_money(c)} AS DECIMAL(38,2)) AS VARCHAR)"


def _int_text(c: str) -> str:
    return f"CAST(CAST({_stripped_money(c)} AS BIGINT) AS VARCHAR)"


_SMALL = """vf AS (SELECT "column", value, count(*) AS cnt FROM cells WHERE value IS NOT NULL GROUP BY 1, 2),
small AS (SELECT vf.* FROM vf JOIN (SELECT "column" FROM vf GROUP BY 1 HAVING count(*) <= 30) USING ("column"))"""

_CATS = f"""vf AS (SELECT "column", value, count(*) AS cnt FROM cells GROUP BY 1, 2),
cats AS (SELECT vf.*, n FROM vf JOIN (SELECT "column", sum(cnt) AS n FROM vf GROUP BY 1
  HAVING count(value) <= 50 AND sum(cnt) FILTER (value IS NOT NULL) > 0
    AND coalesce(sum(cnt) FILTER ({num('value')} IS NOT NULL), 0) / sum(cnt) FILTER (value IS NOT NULL) < 0.9) USING ("column"))"""


def _fences(source: str) -> str:
    """Statistics per column of a (column, x, n) source: two CTEs."""
    return f"""q AS (SELECT "column", any_value(n) AS n, count(x) AS n_values, avg(x) AS mean, stddev_samp(x) AS std, stddev_pop(x) AS pop,
  min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM {source} WHERE x IS NOT NULL GROUP BY 1),
o AS (SELECT s."column", s.x, q.* EXCLUDE ("column"), q1 - 1.5*(q3-q1) AS low, q3 + 1.5*(q3-q1) AS high FROM {source} s JOIN q USING ("column") WHERE s.x IS NOT NULL)"""


def _outliers(std: str, having: str) -> str:
    return f"""SELECT "column", n_values, mean, std, min, max, lower_fence, upper_fence, iqr_outliers, z_outliers, iqr_pct,
  CASE WHEN iqr_pct > 15 THEN 'HIGH' WHEN iqr_pct > 5 THEN 'MODERATE' ELSE 'LOW' END AS severity,
  CASE WHEN iqr_pct > 10 THEN 'HIGH' WHEN iqr_pct >= 1 THEN 'MODERATE' ELSE 'LOW' END AS severity_strict FROM (
SELECT "column", any_value(n_values) AS n_values, round_even(any_value(mean), 2) AS mean, round_even(any_value(std), 2) AS std,
  round_even(any_value(lo), 2) AS min, round_even(any_value(hi), 2) AS max, round_even(any_value(low), 2) AS lower_fence, round_even(any_value(high), 2) AS upper_fence,
  count_if(x < low OR x > high) AS iqr_outliers, count_if({std} > 0 AND abs((x - mean) / {std}) > 3) AS z_outliers,
  round_even(count_if(x < low OR x > high) / any_value(n) * 100, 2) AS iqr_pct FROM o GROUP BY 1) WHERE {having}"""


_NUMERIC = f"""nums AS (SELECT "column", value, {num('value')} AS x FROM cells),
good AS (SELECT "column", count(*) AS n FROM nums GROUP BY 1 HAVING count(value) >= 10 AND count(x) / count(value) >= 0.9),
xs AS (SELECT "column", x, n FROM nums JOIN good USING ("column"))"""
_OUT_DIRTY = f"{WITH}, {_NUMERIC}, {_fences('xs')}"

_EVENT_XS = """xs AS (SELECT unnest(['value', 'user_id', 'event_id']) AS "column", unnest([value, CAST(user_id AS DOUBLE), CAST(event_id AS DOUBLE)]) AS x, count(*) OVER () AS n FROM events)"""
_LINE_NUMERIC = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
_LINE_XS = (
    "xs AS (SELECT unnest([" + ", ".join(f"'{c}'" for c in _LINE_NUMERIC) + ", 'price_per_unit_squared']) AS \"column\", unnest(["
    + ", ".join(f"CAST({c} AS DOUBLE)" for c in _LINE_NUMERIC) + ", pow(l_extendedprice / l_quantity, 2)]) AS x, count(*) OVER () AS n FROM lineitem)"
)


def _pair_union(codes: Sequence[str], labels: Sequence[str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS code_column, '{label}' AS label_column, {_id(c)} AS code, {_id(label)} AS label FROM {source}"""
        for c in codes
        for label in labels
        if c != label
    )


def _code_label(ctes: str, columns: Sequence[str], source: str) -> str:
    """All pairs are built, then restricted to columns that qualify as code and as label."""
    return f"""{ctes}, kind AS (SELECT "column", count({num('value')}) / count(value) AS share, count(DISTINCT {num('value')}) AS numbers,
  count(DISTINCT value) AS uniq FROM cells GROUP BY 1 HAVING count(value) > 0),
codes AS (SELECT "column" FROM kind WHERE share >= 0.9 AND numbers BETWEEN 2 AND 15),
labels AS (SELECT "column" FROM kind WHERE share < 0.5 AND uniq <= 20),
pairs AS ({_pair_union(columns, columns, source)}),
per AS (SELECT code_column, label_column, code, count(DISTINCT label) AS n FROM pairs
  WHERE code IS NOT NULL AND code_column IN (SELECT "column" FROM codes) AND label_column IN (SELECT "column" FROM labels) GROUP BY 1, 2, 3)
SELECT code_column, label_column, count(*) AS codes, count_if(n > 1) AS inconsistent, {pct('count_if(n > 1)', 'count(*)', 1)} AS pct_inconsistent
FROM per GROUP BY 1, 2 HAVING count_if(n > 1) > 0"""


def _period_pairs() -> str:
    others = [c for c in COLUMNS if c != "rata"]
    return " UNION ALL ".join(
        f"SELECT 'rata' AS period_column, '{c}' AS other_column, CAST({num('rata')} AS BIGINT) AS p, CAST(trunc({num(_id(c))}) AS BIGINT) AS o FROM dirty"
        for c in others
    )


_KEYWORD = " OR ".join(f"""contains(lower("column"), '{w}')""" for w in AMOUNT_KEYWORDS)


def _completeness_log(sparse: str) -> str:
    """Log of the completeness fix; ``sparse`` tells a column that is dropped."""
    return f"""gaps AS (SELECT "column", count(*) AS n, count_if(value IS NULL) AS nulls, count_if(value IN {_list(PLACEHOLDERS)}) AS marked, nulls + marked AS missing FROM cells GROUP BY 1),
complete AS (SELECT 'completeness' AS stage, action, "column", CAST(affected AS BIGINT) AS affected FROM (
  SELECT 'placeholder_to_null' AS action, "column", marked AS affected FROM gaps
  UNION ALL SELECT 'drop_sparse_column', "column", missing FROM gaps WHERE {sparse}
  UNION ALL SELECT 'keep_missing', 'ALL', sum(missing) FROM gaps WHERE NOT ({sparse})) WHERE affected > 0)"""


# Trimming, renaming, repeats and kept nulls; the conditions of the suggestions follow from the same figures.
_REMEDIATED = f"""trimmed AS ({_table({c: strip(_id(c)) for c in COLUMNS})}),
remediated AS (SELECT 'remediation' AS stage, 'trim' AS action, "column", CAST(count_if(value <> {strip('value')}) AS BIGINT) AS affected FROM cells GROUP BY "column"
  UNION ALL SELECT DISTINCT 'remediation', 'rename_column', "column", 1 FROM cells WHERE trim(regexp_replace(lower("column"), '[^a-z0-9]+', '_', 'g'), '_') <> "column"
  UNION ALL SELECT 'remediation', 'drop_duplicate_rows', 'ALL', (SELECT count(*) FROM trimmed) - (SELECT count(*) FROM (SELECT DISTINCT * FROM trimmed))
  UNION ALL SELECT 'remediation', 'keep_missing', 'ALL', 1 WHERE EXISTS (FROM cells WHERE {missing('value')}))"""


# The smallest negative number of each of five classes of whole parts.
_NEGATIVE_EXAMPLES = f"""low AS (SELECT "column", min(x) AS x FROM (SELECT "column", {num('value')} AS x FROM cells)
  WHERE x < 0 GROUP BY "column", ((CAST(floor(x) AS BIGINT) % 5) + 5) % 5),
e AS (SELECT "column", string_agg(CAST(CAST(x AS DECIMAL(18,2)) AS VARCHAR), '|' ORDER BY x) AS examples FROM low GROUP BY 1)"""


def _negatives(ctes: str, least: int = 5) -> str:
    return f"""{ctes}, f AS (SELECT "column", count(*) AS n, count(value) AS filled, count({num('value')}) AS numbers,
  count_if({num('value')} < 0) AS negatives, min({num('value')}) AS min_value FROM cells GROUP BY 1),
{_NEGATIVE_EXAMPLES}
SELECT "column", CASE WHEN {_KEYWORD} THEN 'HIGH' ELSE 'MODERATE' END AS priority, negatives, {pct('negatives', 'n')} AS pct_of_rows, min_value, examples
FROM f JOIN e USING ("column") WHERE numbers >= {least} AND numbers / filled >= 0.9 AND negatives > 0"""


def _all_columns(columns: Sequence[str] = COLUMNS) -> str:
    return ", ".join(_id(c) for c in columns)


def _canonical(c: str) -> str:
    """A table (folded, canonical) for one column."""
    return f"""(SELECT lower(v) AS folded, arg_min(v, (-n, v)) AS canonical FROM
      (SELECT {strip(_id(c))} AS v, count(*) AS n FROM dirty WHERE {_id(c)} IS NOT NULL GROUP BY 1) GROUP BY 1)"""


_ISO = f"""coalesce(CAST({date_of(strip('"aggregation-time"'))} AS VARCHAR), "aggregation-time")"""

# --- scores ------------------------------------------------------------------

# Checks whose rows the scores count, too.
_TYPE_CONTAMINATION = f"""{WITH}, nums AS (SELECT "column", value, {num('value')} AS x, value IS NOT NULL AND {num('value')} IS NULL AND {strip('value')} NOT IN {_list(PLACEHOLDERS)} AS odd FROM cells),
        f AS (SELECT "column", count(*) AS row_count, count(value) - count(x) AS bad_count, {pct('count(value) - count(x)', 'count(*)')} AS bad_pct FROM nums GROUP BY 1
          HAVING count(value) > 0 AND count(x) / count(value) >= 0.9 AND count_if(odd) > 0),
        e AS (SELECT "column", string_agg(value, '|' ORDER BY c DESC, value) AS examples FROM (SELECT "column", value, count(*) AS c,
          row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, value) AS rn FROM nums WHERE odd GROUP BY 1, 2) WHERE rn <= 5 GROUP BY 1)
        SELECT f.*, {_CONTAMINATION} AS severity, examples FROM f JOIN e USING ("column")"""
_DATE_CONTAMINATION = f"""{WITH}, r AS (SELECT "column", value, {num('value')} AS x, {strip('value')} AS t FROM cells),
        d AS (SELECT *, {layout('t')} AS lay, {date_of('t')} AS d FROM r),
        best AS (SELECT "column", max(n) AS dates, arg_max(lay, (n, lay)) AS main FROM (SELECT "column", lay, count(d) AS n FROM d GROUP BY 1, 2) GROUP BY 1),
        f AS (SELECT "column", count(*) AS row_count, count(value) AS filled, count(x) AS numbers, count_if(t IN {_list(PLACEHOLDERS)}) AS ph FROM d GROUP BY 1),
        g AS (SELECT "column", row_count, filled - dates AS bad_count, {pct('filled - dates', 'row_count')} AS bad_pct FROM f JOIN best USING ("column")
          WHERE filled > 0 AND dates / filled >= 0.7 AND numbers / filled < 0.5 AND filled - dates > ph),
        e AS (SELECT "column", string_agg(value, '|' ORDER BY c DESC, value) AS examples FROM (SELECT "column", value, count(*) AS c,
          row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, value) AS rn FROM d JOIN best USING ("column")
          WHERE value IS NOT NULL AND t NOT IN {_list(PLACEHOLDERS)} AND (d IS NULL OR lay <> main) GROUP BY 1, 2) WHERE rn <= 5 GROUP BY 1)
        SELECT g.*, {_CONTAMINATION} AS severity, examples FROM g LEFT JOIN e USING ("column")"""
_NAMING_VIOLATIONS = f"""{WITH}, i AS (SELECT "column", count(value) AS cells, [CASE WHEN "column" <> lower("column") THEN 'uppercase' END,
        CASE WHEN contains("column", ' ') THEN 'space' END, CASE WHEN regexp_matches("column", '^[0-9]') THEN 'digit start' END,
        CASE WHEN regexp_matches("column", '[%@!#]') THEN 'special character' END, CASE WHEN contains("column", '-') THEN 'hyphen' END] AS l FROM cells GROUP BY 1)
        SELECT * FROM (SELECT "column", unnest(l) AS issue, cells FROM i) WHERE issue IS NOT NULL"""
_MIXED_FORMATS = f"""{WITH}, d AS (SELECT "column", {_SHAPE} AS format, count(*) AS cells FROM (SELECT "column", {strip('value')} AS t FROM cells WHERE value IS NOT NULL) GROUP BY 1, 2)
        SELECT "column", round_even(coalesce(sum(cells) FILTER (format <> 'other'), 0) / sum(cells), 4) AS date_share, count_if(format <> 'other') AS formats,
        string_agg(format||'='||cells, '|' ORDER BY format||'='||cells) AS distribution FROM d GROUP BY 1
        HAVING coalesce(sum(cells) FILTER (format <> 'other'), 0) / sum(cells) > 0.5 AND count_if(format <> 'other') > 1"""

_FRAGMENTED = f"""{WITH}, d AS (SELECT "column", CASE WHEN regexp_matches(t, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN 'a' WHEN regexp_matches(t, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$') THEN 'b'
          WHEN regexp_matches(t, '^\\d{{2}}-\\d{{2}}-\\d{{2}}$') THEN 'c' WHEN regexp_matches(t, '^\\d{{4}}/\\d{{2}}/\\d{{2}}$') THEN 'd' WHEN regexp_matches(t, '^\\d{{2}}\\.\\d{{2}}\\.\\d{{4}}$') THEN 'e' END AS f
          FROM (SELECT "column", {strip('value')} AS t FROM cells)),
fragmented AS (SELECT "column", count(DISTINCT f) AS formats, count(f) AS cells FROM d GROUP BY 1 HAVING count(DISTINCT f) >= 2)"""
_BARE = "regexp_replace({}, '[€$£,\\s]', '', 'g')"
_WORDS = ", ".join(f"'{w}'" for w in YEAR_WORDS)
_YEARLY = f"""len(list_intersect(string_split(regexp_replace(lower("column"), '[^a-z0-9]+', '_', 'g'), '_'), [{_WORDS}])) > 0"""
_METRICS = f"""{_OUT_DIRTY}, per_out AS ({_outliers('std', 'iqr_outliers > 0 OR z_outliers > 0')}),
mc AS (SELECT "column", round_even(count_if({missing('value')}) * 100.0 / count(*), 2) AS p, round_even((1 - count_if({missing('value')}) / count(*)) * 100, 2) AS c FROM cells GROUP BY 1),
{_CATS.replace('vf AS', 'vfa AS').replace('FROM vf', 'FROM vfa').replace('vf.*', 'vfa.*')},
metrics AS (SELECT CAST({len(COLUMNS)} AS BIGINT) AS column_count, round_even((SELECT avg(p) FROM mc WHERE p > 0), 4) AS avg_missing_pct,
  (SELECT count(*) FROM ({_NAMING_VIOLATIONS})) AS naming_issues,
  (SELECT count(*) FROM ({_TYPE_CONTAMINATION})) + (SELECT count(*) FROM ({_DATE_CONTAMINATION})) AS type_issues, (SELECT round_even(avg(c), 2) FROM mc) AS completeness_pct, (SELECT count(*) FROM ({_MIXED_FORMATS})) AS format_issues,
  (SELECT count(*) FROM dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS duplicate_rows,
  CAST((SELECT sum(iqr_outliers) FROM per_out) AS BIGINT) AS iqr_outliers, CAST((SELECT sum(least(iqr_outliers / 50, 10)) FROM per_out) AS DOUBLE) AS outlier_penalty,
  (SELECT count(*) FROM cats WHERE cnt / n < 0.005) AS rare_values, true AS cross_column),
deducted AS (SELECT *, round_even(least(avg_missing_pct * 0.4, 20), 1) AS missing_deduction, round_even(least(naming_issues * (10 / column_count), 5), 1) AS naming_deduction,
  round_even(least(duplicate_rows / 100, 10), 1) AS duplicate_deduction, round_even(least(iqr_outliers / 50, 10), 1) AS outlier_deduction, 5.0::DOUBLE AS cross_deduction FROM metrics),
scored AS (SELECT *, round_even(100 - missing_deduction - naming_deduction - duplicate_deduction - outlier_deduction - cross_deduction, 1) AS score FROM deducted)"""
_GRADE = "CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' WHEN score >= 60 THEN 'C' WHEN score >= 45 THEN 'D' ELSE 'F' END"
_ROADMAP = """steps AS (SELECT row_number() OVER (ORDER BY score_impact DESC) AS priority, * FROM (
  SELECT 'Consistency' AS category, 'drop_repeats_and_merge_near_ones' AS action, 8.0::DOUBLE AS score_impact, 'easy' AS difficulty, true AS auto_applicable FROM metrics WHERE duplicate_rows > 0
  UNION ALL SELECT 'Completeness', 'fill_or_drop_sparse_columns', 7.0, 'medium', true FROM metrics WHERE avg_missing_pct > 0
  UNION ALL SELECT 'Schema', 'unify_types_and_dates', 6.0, 'easy', true FROM metrics WHERE type_issues + format_issues > 0
  UNION ALL SELECT 'Anomaly', 'check_outliers_and_rare_values', 4.0, 'medium', false FROM metrics WHERE iqr_outliers + rare_values > 0))"""

_TEXTS = """t AS (SELECT o_custkey, count(*) AS n, count_if(o_orderstatus = 'F') AS f FROM orders GROUP BY 1),
texts AS (SELECT o_custkey, concat_ws(chr(10), '[Schema Team] Naming: uppercase names', 'Removed '||n||' exact duplicate rows',
  f||' IQR outliers and '||n||'.5% missing', '  Fixes applied: '||n,
  'Overall score: '||(n+60)||'.5 / 100, grade '||CASE WHEN n > 10 THEN 'B+' ELSE 'c' END,
  CASE WHEN f > 3 THEN 'year is inconsistent with period' ELSE 'periods agree' END) AS text FROM t)"""


def _captured(text: str, pattern: str) -> str:
    return f"coalesce(list_sum(list_transform(regexp_extract_all({text}, '(?i){pattern}', 1), lambda s: CAST(trunc(TRY_CAST(s AS DOUBLE)) AS BIGINT))), 0)"


def _kept(text: str, prefixes: Sequence[str]) -> str:
    tests = " OR ".join(f"starts_with({strip('lower(l)')}, '{p}')" for p in prefixes)
    return strip(f"array_to_string(list_filter(string_split({text}, chr(10)), lambda l: NOT ({tests})), chr(10))")


_PREFIXES = (
    "[schema team]", "[completeness team]", "[consistency team]", "[anomaly team]", "[remediation team]",
    "fixes applied:", "fixed csv:", "final cleaned dataset:",
)

# --- fixes in sequence -------------------------------------------------------

_SCHEMA_FIXED = {
    "rata": _int_text("rata"),
    "anno": f"CAST(CASE WHEN {num('anno')} >= 0 AND {num('anno')} < 30 THEN CAST(anno AS BIGINT) + 2000 "
    f"WHEN {num('anno')} >= 30 AND {num('anno')} < 100 THEN CAST(anno AS BIGINT) + 1900 ELSE CAST(anno AS BIGINT) END AS VARCHAR)",
    "mese": _int_text("mese"),
    "spesa": _money_text("spesa"),
    "cod_stato": _int_text("cod_stato"),
    "quota": f"CAST(CAST(round_even({num('quota')}, 2) AS DECIMAL(38,2)) AS VARCHAR)",
}
_V1 = "v1 AS (" + _table(_SCHEMA_FIXED, ["SPESA TOTALE"]).replace('"aggregation-time"', '"aggregation-time" AS aggregation_time') + ")"


def _case_fixed(source: str, c: str) -> str:
    return f"""(SELECT lower(v) AS folded, arg_min(v, (-n, v)) AS canonical FROM (SELECT {strip(c)} AS v, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 1) GROUP BY 1)"""


_PIPELINE = f"""{WITH}, {_V1},
v2 AS (SELECT "_id" AS id, rata, anno, mese, spesa, aggregation_time, cod_stato, priorita,
  CASE WHEN stato NOT IN {_list(PLACEHOLDERS)} THEN stato END AS stato,
  CASE WHEN area_geografica NOT IN {_list(PLACEHOLDERS)} THEN area_geografica END AS area_geografica, quota FROM v1),
v3 AS (SELECT DISTINCT id, rata, anno, mese, spesa, coalesce(CAST({date_of(strip('aggregation_time'))} AS VARCHAR), aggregation_time) AS aggregation_time,
  cod_stato, cp.canonical AS priorita, cs.canonical AS stato, {strip('area_geografica')} AS area_geografica, quota
  FROM v2 LEFT JOIN {_case_fixed('v2', 'priorita')} cp ON lower({strip('priorita')}) = cp.folded
  LEFT JOIN {_case_fixed('v2', 'stato')} cs ON lower({strip('stato')}) = cs.folded)"""


_V1_COLUMNS = (
    "_id", "rata", "anno", "mese", "spesa", "aggregation_time", "cod_stato", "priorita", "stato", "area_geografica",
    "note", "quota", "fonte_dato",
)
_V3_COLUMNS = (
    "id", "rata", "anno", "mese", "spesa", "aggregation_time", "cod_stato", "priorita", "stato", "area_geografica", "quota",
)


ORACLE: dict[str, str] = {
    "csv_scan": f"""{WITH} SELECT "column", CAST(any_value(ordinal) AS INT) AS ordinal, count(*) AS row_count,
        count_if(value IS NULL OR value IN {_list(NA_STRINGS)}) AS null_count, ';' AS delimiter FROM cells GROUP BY 1""",
    "csv_inferred": """SELECT unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS "column", count(*) AS row_count,
        unnest(['int', 'string', 'int', 'double', 'string']) AS dtype FROM customer""",
    "repeated_stage_log": """WITH r AS (SELECT count_if(c_custkey % 5 = 0) AS removed, count(*) + count_if(c_custkey % 5 = 0) AS total,
            count_if(c_custkey % 4 = 0) + count_if(c_custkey % 20 = 0) AS missing FROM customer),
        planned AS (SELECT 1 AS place, 'schema' AS stage, 'profile' AS reason, 0 AS rows_removed
        UNION ALL SELECT 2, 'completeness', 'profile', 0 FROM r WHERE 1 - missing / (4 * total) < 0.95
        UNION ALL SELECT 3, 'consistency', 'profile', removed FROM r WHERE total >= 10
        UNION ALL SELECT 4, 'completeness', 'rows or types changed', 0 FROM r WHERE removed > 0.1 * total
        UNION ALL SELECT 5, 'anomaly', 'profile', 0 UNION ALL SELECT 6, 'remediation', 'profile', 0)
        SELECT row_number() OVER (ORDER BY place) AS step, stage, reason, CAST(rows_removed AS BIGINT) AS rows_removed FROM planned""",
    "repeated_stage_findings": """SELECT 'c_acctbal' AS "column", 'null_pct' AS metric, round_even(count_if(c_custkey % 4 = 0) / count(*) * 100, 2) AS value FROM customer""",
    "csv_malformed": "SELECT CASE WHEN c_custkey % 3 = 0 THEN chr(65533) ELSE '' END || c_name AS c_name, c_custkey FROM customer",
    "nested_columns": """WITH c AS (SELECT *, concat_ws('|', c_nationkey, c_custkey % 3) AS codes FROM customer)
        SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, codes, 'nation='||c_nationkey||'|segment='||c_mktsegment AS facts, c_mktsegment AS segment, CAST(c_nationkey AS BIGINT) AS nation
        FROM (FROM c UNION ALL SELECT * REPLACE (codes||'|-1' AS codes) FROM c WHERE c_custkey % 7 = 0)""",
    "csv_quoted_breaks": "SELECT doc_id, lang, source, length(text) AS n_chars, md5(text) AS text_md5 FROM documents",
    "findings_json": f"""{_MISS}, p AS (SELECT "column", {pct('null_count', 'row_count')} AS null_pct, null_count / row_count AS share FROM m WHERE null_count > 0)
        SELECT 'missing' AS "check", "column", 'null_pct' AS metric, null_pct AS value, {_SEVERITY.format(r='null_pct')} AS severity FROM p
        UNION ALL SELECT 'sparse', "column", 'missing_pct', round_even(share * 100, 2), CASE WHEN share > 0.95 THEN 'removal candidate' ELSE 'high sparsity' END FROM p WHERE share > 0.5
        UNION ALL SELECT 'completeness', 'ALL', 'overall_completeness_pct', rate, CASE WHEN rate >= 95 THEN 'EXCELLENT' WHEN rate >= 80 THEN 'GOOD' WHEN rate >= 60 THEN 'MODERATE' ELSE 'POOR' END
          FROM (SELECT round_even(avg(round_even((1 - null_count / row_count) * 100, 2)), 2) AS rate FROM m)
        UNION ALL SELECT 'rows_with_missing', 'ALL', 'rows_with_any_null', CAST(count_if({' OR '.join(missing(_id(c)) for c in COLUMNS)}) AS DOUBLE), NULL FROM dirty""",
    "stage_versions": f"{WITH} {_table(_CLEAR)}",
    "profile_dirty": f"{PROFILE} SELECT * FROM profile",
    "profile_lineitem": _profile(f"{LINE_TEXT}, {_cells('src', _LINE)}", _LINE) + "SELECT * FROM profile",
    "profile_events": _profile(
        _text_of("events", ("event_id", "ts", "user_id", "event_type", "value", "props"), ("value",))
        + ", " + _cells("src", ("event_id", "ts", "user_id", "event_type", "value", "props")), ()
    )
    + "SELECT * FROM profile",
    "profile_summary": f"{SUMMARY} SELECT * FROM summary",
    "stage_gates": f"""{SUMMARY} SELECT overall_completeness < 0.95 AS completeness, total_columns >= 3 AND total_rows >= 10 AS consistency,
        numeric_columns <> '' OR categorical_columns <> '' AS anomaly FROM summary""",
    "missing_by_column": f"""{_MISS} SELECT *, {pct('null_count', 'row_count')} AS null_pct FROM m WHERE null_count > 0""",
    "missing_split": f"""{WITH}, s AS (SELECT "column", CAST(any_value(ordinal) AS INT) AS ordinal, count(*) AS row_count, count_if(value IS NULL) AS true_nulls,
        count_if(value IN {_list(PLACEHOLDERS)}) AS placeholders FROM cells GROUP BY 1)
        SELECT *, {pct('true_nulls + placeholders', 'row_count')} AS combined_pct FROM s""",
    "rows_with_missing": f"""{WITH}, r AS (SELECT count(*) AS total_rows, count_if({' OR '.join(missing(_id(c)) for c in COLUMNS)}) AS rows_with_any_null FROM dirty)
        SELECT *, {pct('rows_with_any_null', 'total_rows')} AS rows_pct FROM r""",
    "completeness_rate": f"""{_MISS} SELECT *, round_even((1 - null_count / row_count) * 100, 2) AS completeness_pct FROM m""",
    "completeness_overall": f"""{_MISS}, o AS (SELECT round_even(avg(round_even((1 - null_count / row_count) * 100, 2)), 2) AS overall_completeness_pct,
        round_even((1 - sum(null_count) / sum(row_count)) * 100, 2) AS cell_completeness_pct FROM m)
        SELECT *, CASE WHEN overall_completeness_pct >= 95 THEN 'EXCELLENT' WHEN overall_completeness_pct >= 80 THEN 'GOOD'
        WHEN overall_completeness_pct >= 60 THEN 'MODERATE' ELSE 'POOR' END AS completeness_class FROM o""",
    "missing_severity": f"""{_MISS}, p AS (SELECT *, {pct('null_count', 'row_count')} AS null_pct FROM m)
        SELECT *, round_even(100 - null_pct, 2) AS completeness_pct, {_SEVERITY.format(r='null_pct')} AS severity,
        CASE WHEN null_pct > 95 THEN 'CRITICAL' WHEN null_pct >= 20 THEN 'HIGH' WHEN null_pct >= 5 THEN 'MODERATE' ELSE 'LOW' END AS severity_strict,
        CASE WHEN null_pct >= 95 THEN '>=95' WHEN null_pct >= 50 THEN '50-95' WHEN null_pct >= 5 THEN '5-50' ELSE '<5' END AS band FROM p""",
    "sparse_columns": f"""{_MISS} SELECT *, round_even(null_count / row_count * 100, 2) AS missing_pct,
        CASE WHEN null_count / row_count > 0.95 THEN 'removal candidate' ELSE 'high sparsity' END AS bucket FROM m WHERE null_count / row_count > 0.5""",
    "co_missing": f"""{WITH} SELECT concat_ws(',', {', '.join(f"CASE WHEN {missing(_id(c))} THEN '{c}' END" for c in COLUMNS)}) AS missing_columns, count(*) AS rows FROM dirty GROUP BY 1""",
    "placeholder_null": f"{WITH} {_table(_CLEAR)}",
    "completeness_fix": f"{WITH} {_table(_CLEAR, ['note', 'fonte_dato'])}",
    "missing_indicators": f"""{WITH} SELECT "_id", {_CLEAR['spesa']} AS spesa, {_CLEAR['area_geografica']} AS area_geografica,
        CAST({missing('spesa')} AS INT) AS spesa_is_missing, CAST({missing('area_geografica')} AS INT) AS area_geografica_is_missing FROM dirty""",
    "fill_unknown": f"""{WITH} SELECT "_id", stato, coalesce(area_geografica, 'Unknown') AS area_geografica, coalesce(note, 'Unknown') AS note FROM dirty""",
    "fill_mode": f"""{WITH}, a AS (SELECT area_geografica AS v FROM dirty WHERE area_geografica IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
        b AS (SELECT note AS v FROM dirty WHERE note IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT "_id", coalesce(area_geografica, (SELECT v FROM a)) AS area_geografica, coalesce(note, (SELECT v FROM b)) AS note FROM dirty""",
    "type_contamination": _TYPE_CONTAMINATION,
    "date_contamination": _DATE_CONTAMINATION,
    "stripped_contamination": f"""{WITH}, r AS (SELECT "column", value, {num("regexp_replace(value, '[€$,\\s]', '', 'g')")} AS x FROM cells)
        SELECT "column", count(*) - count(x) AS contaminated_rows, {pct('count(*) - count(x)', 'count(*)')} AS contamination_pct FROM r GROUP BY 1
        HAVING count(value) > 0 AND count(x) / count(value) > 0.7""",
    "naming_violations": _NAMING_VIOLATIONS,
    "snake_case_violations": f"""{WITH}, i AS (SELECT "column", count(value) AS cells, [CASE WHEN regexp_matches("column", '^[0-9]') THEN 'starts_with_digit' END,
        CASE WHEN "column" <> lower("column") THEN 'uppercase' END, CASE WHEN contains("column", ' ') THEN 'contains_space' END,
        CASE WHEN contains("column", '-') THEN 'contains_hyphen' END, CASE WHEN regexp_matches("column", '[^a-zA-Z0-9_ ]') THEN 'special_chars' END,
        CASE WHEN NOT regexp_matches("column", '[^a-z0-9_]|^[0-9]') THEN 'not_snake_case' END] AS l FROM cells
        WHERE NOT regexp_matches("column", '^[a-z][a-z0-9_]*$') GROUP BY 1)
        SELECT * FROM (SELECT "column", unnest(l) AS issue, cells FROM i) WHERE issue IS NOT NULL""",
    "duplicate_columns": f"""{WITH}, v AS (SELECT DISTINCT "column", ordinal, value, regexp_replace(lower("column"), '[^a-z0-9]', '', 'g') AS r FROM cells WHERE value IS NOT NULL),
        size AS (SELECT "column", any_value(ordinal) AS ordinal, any_value(r) AS r, count(*) AS n FROM v GROUP BY 1),
        shared_values AS (SELECT a."column" AS ca, b."column" AS cb, count(*) AS shared FROM v a JOIN v b USING (value) WHERE a.ordinal < b.ordinal GROUP BY 1, 2),
        j AS (SELECT ca AS "column", cb AS column_b, sb.ordinal, shared / (sa.n + sb.n - shared) AS jaccard FROM shared_values JOIN size sa ON sa."column" = ca JOIN size sb ON sb."column" = cb
          WHERE length(sa.r) >= 3 AND length(sb.r) >= 3 AND (contains(sa.r, sb.r) OR contains(sb.r, sa.r)))
        SELECT "column", arg_max(column_b, ordinal) AS column_b, round_even(arg_max(jaccard, ordinal), 4) AS jaccard FROM j WHERE jaccard > 0.8 GROUP BY 1""",
    "domain_overlap": """WITH o AS (SELECT DISTINCT l_orderkey AS v FROM lineitem), p AS (SELECT DISTINCT l_partkey AS v FROM lineitem), s AS (SELECT DISTINCT l_suppkey AS v FROM lineitem),
        c AS (SELECT (SELECT count(*) FROM o) AS no, (SELECT count(*) FROM p) AS np, (SELECT count(*) FROM s) AS ns,
          (SELECT count(*) FROM o JOIN p USING (v)) AS op, (SELECT count(*) FROM o JOIN s USING (v)) AS os, (SELECT count(*) FROM p JOIN s USING (v)) AS ps)
        SELECT 'l_orderkey' AS "column", 'l_partkey' AS column_b, no AS distinct_a, np AS distinct_b, op AS shared, round_even(op / (no + np - op), 4) AS jaccard FROM c
        UNION ALL SELECT 'l_orderkey', 'l_suppkey', no, ns, os, round_even(os / (no + ns - os), 4) FROM c
        UNION ALL SELECT 'l_partkey', 'l_suppkey', np, ns, ps, round_even(ps / (np + ns - ps), 4) FROM c""",
    "redundant_pairs": f"""{WITH}, pairs AS ({' UNION ALL '.join(
        f"SELECT '{a}' AS col1, '{b}' AS col2, lower({strip(_id(a))}) AS x, lower({strip(_id(b))}) AS y FROM dirty"
        for i, a in enumerate(COLUMNS) for b in COLUMNS[i + 1:])})
        SELECT col1, col2, count(x = y) AS rows_compared, round_even(count_if(x = y) / count(x = y) * 100, 1) AS overlap_pct FROM pairs GROUP BY 1, 2
        HAVING count(x = y) > 10 AND count_if(x = y) / count(x = y) > 0.85""",
    "strip_currency": f"""{WITH} SELECT "_id", {_money_text('spesa')} AS spesa, {_int_text('mese')} AS mese FROM dirty""",
    "coerce_years": f"""{WITH} SELECT "_id", CAST({_SCHEMA_FIXED['anno']} AS BIGINT) AS anno, mese FROM dirty""",
    "round_decimals": f"""{WITH} SELECT "_id", {_SCHEMA_FIXED['quota']} AS quota FROM dirty""",
    "coerce_integers": "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, l_discount FROM lineitem",
    "mostly_numeric": f"""{WITH}, chosen AS (SELECT "column" FROM (SELECT "column", value, {num(_BARE.format('value'))} AS x FROM cells) GROUP BY 1
        HAVING count(value) > 50 AND count(x) / count(value) > 0.9) """
    + _table({c: f"CASE WHEN '{c}' IN (FROM chosen) THEN CAST(CAST({num(_BARE.format(_id(c)))} AS DECIMAL(38,2)) AS VARCHAR) ELSE {_id(c)} END" for c in COLUMNS}),
    "overlapping_columns": f"{WITH} {_table({}, ['SPESA TOTALE'])}",
    "redundant_columns": f"{WITH} {_table({}, ['SPESA TOTALE'])}",
    "snake_case_names": f"""{WITH} SELECT "_id" AS id, rata, anno, mese, spesa, "SPESA TOTALE" AS spesa_totale, "aggregation-time" AS aggregation_time,
        cod_stato, priorita, stato, area_geografica, note, quota, fonte_dato FROM dirty""",
    "enrichment_proposals": f"""{PROFILE.rstrip()}, r AS (SELECT "column", value, {num('value')} AS x, regexp_matches(value, '\\.(\\d*?)(0{{6,}}|9{{6,}})\\d{{1,3}}$') AS noisy FROM cells
          WHERE "column" IN (SELECT "column" FROM profile WHERE semantic_type = 'numeric')),
        g AS (SELECT "column", count_if(x IS NOT NULL AND noisy) AS noisy, coalesce(max(length(regexp_extract(value, '\\.(\\d*?)(0{{6,}}|9{{6,}})\\d{{1,3}}$', 1))) FILTER (noisy AND x IS NOT NULL), 0) AS dn,
          coalesce(max(length(regexp_extract(value, '\\.(\\d+)$', 1))) FILTER (NOT noisy AND x IS NOT NULL), 0) AS dc, bool_and(x % 1 = 0) AS whole, count_if(x IS NOT NULL AND contains(value, '.')) AS pointed,
          count_if(x BETWEEN 20 AND 99) AS short, count_if(x >= 0 AND x < 20) AS tiny, count_if(x BETWEEN 1900 AND 2100) AS long FROM r GROUP BY 1)
        SELECT * FROM (SELECT "column", CASE WHEN {_YEARLY} AND short > 0 AND long > 0 AND tiny = 0 THEN 'coerce_year' WHEN noisy > 0 AND dc <= 6 THEN 'round_Ndp'
          WHEN whole AND pointed > 0 THEN 'coerce_int' END AS fix_action, CASE WHEN NOT ({_YEARLY} AND short > 0 AND long > 0 AND tiny = 0) AND noisy > 0 AND dc <= 6 THEN greatest(dn, dc) END AS decimals FROM g) WHERE fix_action IS NOT NULL""",
    "schema_fix": f"{WITH}, {_V1} SELECT * FROM v1",
    "format_distribution": f"""{WITH} SELECT "column", {_SHAPE} AS format, count(*) AS cells FROM (SELECT "column", {strip('value')} AS t FROM cells WHERE value IS NOT NULL) GROUP BY 1, 2""",
    "mixed_formats": _MIXED_FORMATS,
    "fragmented_dates": f"{_FRAGMENTED} SELECT * FROM fragmented",
    "period_outliers": f"""{WITH}, f AS (SELECT "column", count(value) AS filled, count_if(regexp_matches({strip('value')}, '^(19|20)\\d{{2}}(0[1-9]|1[0-2])$')) AS codes FROM cells GROUP BY 1)
        SELECT "column", filled, filled - codes AS not_period FROM f WHERE filled > codes AND codes / filled > 0.8""",
    "date_outliers": f"""{WITH}, d AS (SELECT "column", count(*) AS filled, count_if({_SHAPE} <> 'other') AS dated FROM (SELECT "column", {strip('value')} AS t FROM cells WHERE value IS NOT NULL) GROUP BY 1)
        SELECT "column", filled, filled - dated AS not_date FROM d WHERE filled > dated AND dated / filled > 0.6""",
    "mixed_case_style": f"""{WITH}, f AS (SELECT "column", count(value) AS filled, count_if(w) AS worded, count_if(w AND value = upper(value)) AS upper_cells, count_if(w AND value = lower(value)) AS lower_cells,
          count_if(w AND value = array_to_string(list_transform(string_split(value, ' '), lambda s: upper(s[1])||lower(s[2:])), ' ')) AS title_cells
          FROM (SELECT *, regexp_matches(value, '[A-Za-z]') AS w FROM cells) GROUP BY 1)
        SELECT "column", worded, upper_cells, lower_cells, title_cells FROM f WHERE filled > 0 AND worded / filled > 0.5 AND greatest(upper_cells, lower_cells, title_cells) / worded <= 0.7""",
    "whitespace_variants": f"""{WITH}, {_SMALL}
        SELECT "column", count(*) AS raw_values, count(DISTINCT {strip('value')}) AS trimmed_values, CAST(coalesce(sum(cnt) FILTER (value <> {strip('value')}), 0) AS BIGINT) AS padded_cells
        FROM small GROUP BY 1 HAVING count(DISTINCT {strip('value')}) < count(*)""",
    "case_variants": f"""{WITH}, {_SMALL}, forms AS (SELECT "column", {strip('value')} AS form, sum(cnt) AS cnt FROM small GROUP BY 1, 2)
        SELECT "column", lower(form) AS folded, count(*) AS variants, CAST(sum(cnt) AS BIGINT) AS cells, string_agg(form, '|' ORDER BY form) AS forms FROM forms GROUP BY 1, 2 HAVING count(*) > 1""",
    "case_variants_any": f"""{WITH}, {_SMALL}
        SELECT "column", lower({strip('value')}) AS folded, value AS form, CAST(cnt AS BIGINT) AS cells FROM vf QUALIFY count(*) OVER (PARTITION BY "column", lower({strip('value')})) > 1""",
    "code_label": _code_label(WITH, COLUMNS, "dirty"),
    "code_label_lineitem": _code_label(f"WITH {LINE_TEXT}, {_cells('src', _LINE)}", _LINE, "src"),
    "code_label_by_name": f"""{WITH}, per AS (SELECT cod_stato, count(DISTINCT stato) AS n FROM dirty WHERE cod_stato IS NOT NULL GROUP BY 1)
        SELECT 'cod_stato' AS code_column, 'stato' AS label_column, count(*) AS codes, count_if(n > 1) AS inconsistent, {pct('count_if(n > 1)', 'count(*)', 1)} AS pct_inconsistent FROM per HAVING count_if(n > 1) > 0""",
    "period_mismatches": f"""{WITH}, periods AS (SELECT "column" FROM (SELECT "column", value, {num('value')} AS x FROM cells) GROUP BY 1
          HAVING count(value) >= 5 AND count(x) / count(value) >= 0.9 AND count_if(x BETWEEN 190001 AND 210012 AND x % 100 BETWEEN 1 AND 12) / count(x) >= 0.9),
        pairs AS ({_period_pairs()}),
        f AS (SELECT period_column, other_column, count(*) AS n, count(o) AS numeric_rows, count_if(p IS NOT NULL AND o IS NOT NULL) AS aligned_rows, count_if(p IS NOT NULL AND o BETWEEN 1900 AND 2100) AS years,
          count_if(p IS NOT NULL AND o BETWEEN 1 AND 12) AS months, count_if(p // 100 <> o) AS off_year, count_if(p % 100 <> o) AS off_month FROM pairs GROUP BY 1, 2),
        g AS (SELECT *, CASE WHEN years / aligned_rows >= 0.9 THEN 'year' WHEN months / aligned_rows >= 0.9 THEN 'month' END AS part FROM f WHERE numeric_rows / n >= 0.9 AND aligned_rows >= 5
          AND period_column IN (SELECT "column" FROM periods)),
        off AS (SELECT period_column, other_column, part, min((p, o)) AS pair FROM pairs JOIN (FROM g WHERE part IS NOT NULL) USING (period_column, other_column)
          WHERE CASE part WHEN 'year' THEN p // 100 ELSE p % 100 END <> o GROUP BY 1, 2, 3, p % 5),
        e AS (SELECT period_column, other_column, part, string_agg(pair[1]||': '||pair[2], '|' ORDER BY pair) AS examples FROM off GROUP BY 1, 2, 3)
        SELECT period_column, other_column, part, aligned_rows, CASE part WHEN 'year' THEN off_year ELSE off_month END AS mismatch_count,
          round_even(CASE part WHEN 'year' THEN off_year ELSE off_month END / aligned_rows * 100, 1) AS pct_mismatch, examples FROM g
          JOIN e USING (period_column, other_column, part) WHERE part IS NOT NULL AND CASE part WHEN 'year' THEN off_year ELSE off_month END > 0""",
    "negative_values": _negatives(WITH),
    "negative_values_ten": _negatives(WITH, 10),
    "same_names": f"{WITH} SELECT * FROM dirty",
    "valid_enrichments": """SELECT CAST(c_nationkey AS VARCHAR) AS "column", CASE max(c_custkey) % 5 WHEN 0 THEN 'round_Ndp' WHEN 2 THEN 'coerce_int' ELSE 'coerce_year' END AS fix_action
        FROM customer GROUP BY c_nationkey HAVING max(c_custkey) % 5 IN (0, 2, 4)""",
    "completeness_log": f"{WITH}, {_completeness_log('missing / n > 0.95')} SELECT * FROM complete",
    "completeness_log_inclusive": f"{WITH}, {_completeness_log('round_even(missing / n * 100, 2) >= 95')} SELECT * FROM complete",
    "remediation_log": f"{WITH}, {_REMEDIATED} SELECT * FROM remediated WHERE affected > 0",
    "changes_by_stage": f"""{WITH}, {_completeness_log('missing / n > 0.95')}, {_REMEDIATED}
        SELECT stage, count(*) AS changes, CAST(sum(affected) AS BIGINT) AS affected FROM (FROM complete UNION ALL FROM remediated WHERE affected > 0) GROUP BY 1""",
    "negative_balances": _negatives(f"WITH {_text_of('customer', ('c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment'), ('c_acctbal',))}, {_cells('src', ('c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment'))}")
    + " UNION ALL SELECT * FROM ("
    + _negatives(f"WITH {_text_of('supplier', ('s_suppkey', 's_name', 's_nationkey', 's_acctbal'), ('s_acctbal',))}, {_cells('src', ('s_suppkey', 's_name', 's_nationkey', 's_acctbal'))}")
    + ")",
    "negative_native": _negatives(
        f"WITH {_text_of('customer', ('c_custkey', 'c_nationkey', 'c_acctbal'), ('c_acctbal',))}, {_cells('src', ('c_custkey', 'c_nationkey', 'c_acctbal'))}"
    ),
    "exact_duplicates": f"""{WITH}, d AS (SELECT (SELECT count(*) FROM dirty) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS rows_after)
        SELECT total_rows, total_rows - rows_after AS duplicate_rows, {pct('total_rows - rows_after', 'total_rows')} AS duplicate_pct, rows_after FROM d""",
    "duplicate_texts": f"""WITH d AS (SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT text FROM documents)) AS rows_after FROM documents)
        SELECT total_rows, total_rows - rows_after AS duplicate_rows, {pct('total_rows - rows_after', 'total_rows')} AS duplicate_pct, rows_after FROM d""",
    "near_duplicates": f"""{WITH}, ratio AS (SELECT "column", any_value(ordinal) AS ordinal, count(DISTINCT value) / count(*) AS r FROM cells GROUP BY 1
          HAVING count(value) > 0 AND count(DISTINCT value) / count(*) BETWEEN 0.05 AND 0.95 AND avg(length(value)) < 30),
        keys AS (SELECT "column", row_number() OVER (ORDER BY r DESC, ordinal) AS rn FROM ratio),
        named AS (SELECT string_agg("column", ',' ORDER BY rn) AS key_columns FROM keys WHERE rn <= 4),
        g AS (SELECT count(*) AS n FROM dirty GROUP BY quota, spesa, "SPESA TOTALE", "aggregation-time" HAVING count(*) > 1)
        SELECT any_value(key_columns) AS key_columns, count(n) AS key_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS affected_rows FROM named LEFT JOIN g ON true""",
    "near_duplicate_rows": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
    "differing_duplicates": f"""WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT ({', '.join(c for c in _LINE if c not in ('l_orderkey', 'l_linenumber'))})) AS v FROM lineitem GROUP BY 1, 2)
        SELECT 'l_orderkey,l_linenumber' AS key_columns, count(*) AS key_groups, CAST(sum(n) AS BIGINT) AS affected_rows FROM g WHERE v > 1""",
    "named_key_duplicates": f"""{WITH}, u AS (SELECT count(*) AS c, {_all_columns(COLUMNS[1:])} FROM dirty GROUP BY ALL), g AS (SELECT cod_stato, count(*) AS v, sum(c) AS n FROM u GROUP BY 1)
        SELECT 'cod_stato' AS key_columns, count(*) AS key_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS affected_rows FROM g WHERE v > 1""",
    "dedup": f"{WITH} SELECT DISTINCT * FROM dirty",
    "normalize_dates": f"""{WITH} SELECT "_id", {_ISO} AS "aggregation-time" FROM dirty""",
    "fragmented_dates_fix": f"{_FRAGMENTED} "
    + _table({c: f"CASE WHEN '{c}' IN (SELECT \"column\" FROM fragmented) THEN CAST({date_of(strip(_id(c)))} AS VARCHAR) ELSE {_id(c)} END" for c in COLUMNS}),
    "normalize_periods": f"""{WITH} SELECT "_id", CASE WHEN regexp_matches(rata, '^\\d{{6}}$') THEN rata WHEN regexp_matches(rata, '^\\d{{4}}-\\d{{2}}$') THEN replace(rata, '-', '')
        WHEN regexp_matches(rata, '^[A-Z]{{3}}-\\d{{4}}$') THEN strftime(strptime('01 '||replace({_english('rata')}, '-', ' '), '%d %b %Y'), '%Y%m') ELSE rata END AS rata FROM dirty""",
    "canonical_case": f"""{WITH} SELECT "_id", p.canonical AS priorita, s.canonical AS stato FROM dirty LEFT JOIN {_canonical('priorita')} p ON lower({strip('priorita')}) = p.folded
        LEFT JOIN {_canonical('stato')} s ON lower({strip('stato')}) = s.folded""",
    "lower_variants": f"""{WITH}, varied AS (SELECT DISTINCT "column" FROM (SELECT "column" FROM cells WHERE value IS NOT NULL GROUP BY "column", lower({strip('value')}) HAVING count(DISTINCT value) > 1)) """
    + _table({c: f"CASE WHEN '{c}' IN (FROM varied) THEN lower({strip(_id(c))}) ELSE {_id(c)} END" for c in COLUMNS}),
    "consistency_fix": f"""{WITH}, f AS (SELECT "_id", rata, anno, mese, spesa, "SPESA TOTALE", {_ISO} AS "aggregation-time", cod_stato, p.canonical AS priorita, s.canonical AS stato,
          {strip('area_geografica')} AS area_geografica, {strip('note')} AS note, quota, {strip('fonte_dato')} AS fonte_dato FROM dirty
          LEFT JOIN {_canonical('priorita')} p ON lower({strip('priorita')}) = p.folded LEFT JOIN {_canonical('stato')} s ON lower({strip('stato')}) = s.folded)
        SELECT DISTINCT * FROM f""",
    "outliers_dirty": f"{_OUT_DIRTY} {_outliers('std', 'iqr_outliers > 0 OR z_outliers > 0')}",
    "outliers_events": f"WITH {_EVENT_XS}, {_fences('xs')} {_outliers('std', 'iqr_outliers > 0 OR z_outliers > 0')}",
    "outliers_lineitem": f"WITH {_LINE_XS}, {_fences('xs')} {_outliers('pop', 'iqr_outliers > 0')}",
    "largest_outliers": f"""{_OUT_DIRTY} SELECT "column", string_agg(CAST(CAST(x AS DECIMAL(18,2)) AS VARCHAR), '|' ORDER BY x DESC) AS examples FROM
        (SELECT "column", x, row_number() OVER (PARTITION BY "column" ORDER BY x DESC) AS rn FROM o WHERE x < low OR x > high) WHERE rn <= 5 GROUP BY 1""",
    "largest_deviations": f"""{_OUT_DIRTY}, m AS (SELECT "column", avg(x) AS mean, stddev_samp(x) AS std FROM xs GROUP BY 1)
        SELECT "column", string_agg(CAST(CAST(x AS DECIMAL(18,2)) AS VARCHAR), '|' ORDER BY x DESC) AS examples FROM
        (SELECT "column", x, row_number() OVER (PARTITION BY "column" ORDER BY x DESC) AS rn FROM xs JOIN m USING ("column") WHERE abs(x - mean) > 3 * std) WHERE rn <= 5 GROUP BY 1""",
    "outlier_flags": """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
        SELECT event_id, value, CASE WHEN value < a - 1.5*(b-a) OR value > b + 1.5*(b-a) THEN 1 ELSE 0 END AS value_outlier_flag FROM events, q""",
    "rare_categories": f"""{WITH}, {_CATS} SELECT "column", value, cnt, {pct('cnt', 'n', 3)} AS pct FROM cats WHERE cnt / n < 0.005""",
    "rare_values": f"""{WITH}, v AS (SELECT "column", value, count(*) AS cnt, sum(count(*)) OVER (PARTITION BY "column") AS n FROM cells
        WHERE value IS NOT NULL GROUP BY 1, 2) SELECT "column", value, cnt, {pct('cnt', 'n', 3)} AS pct FROM v WHERE cnt / n < 0.005
        QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY cnt DESC, value) <= 10""",
    "invalid_markers": f"""{WITH}, {_CATS} SELECT "column", value, cnt, {pct('cnt', 'n', 3)} AS pct FROM cats WHERE value IN {_list(INVALID_MARKERS)}""",
    "placeholder_words": f"""{WITH} SELECT "column", value, count(*) AS cnt, {pct('count(*)', '(SELECT count(*) FROM dirty)')} AS pct FROM cells WHERE lower({strip('value')}) IN {_list(PLACEHOLDER_WORDS)} GROUP BY 1, 2""",
    "clear_placeholder_words": f"{WITH} " + _table({c: f"CASE WHEN lower({strip(_id(c))}) NOT IN {_list(PLACEHOLDER_WORDS)} THEN {_id(c)} END" for c in COLUMNS}),
    "dominant_category": f"""{WITH}, {_CATS} SELECT "column", count(*) AS distinct_values, arg_min(value, (-cnt, value)) AS dominant, max(cnt) AS dominant_count, {pct('max(cnt)', 'any_value(n)')} AS dominant_pct
        FROM cats WHERE value IS NOT NULL GROUP BY 1""",
    "frequent_values": f"""{WITH}, v AS (SELECT "column", value, count(*) AS cnt FROM cells GROUP BY 1, 2), ok AS (SELECT "column", sum(cnt) AS n FROM v GROUP BY 1
          HAVING coalesce(sum(cnt) FILTER ({num('value')} IS NOT NULL), 0) / sum(cnt) FILTER (value IS NOT NULL) < 0.8 AND (count(value) < 50 OR count(value) / sum(cnt) < 0.05)),
        r AS (SELECT v.*, n, row_number() OVER (PARTITION BY "column" ORDER BY cnt DESC, value) AS place FROM v JOIN ok USING ("column") WHERE value IS NOT NULL)
        SELECT "column", CAST(place AS INT) AS place, value, cnt, {pct('cnt', 'n', 3)} AS pct FROM r WHERE place <= 5""",
    "anomaly_rates": f"""{_OUT_DIRTY}, {_CATS}, a AS (SELECT "column", count_if(x < low OR x > high) AS anomalies FROM o GROUP BY 1
          UNION ALL SELECT "column", CAST(sum(cnt) AS BIGINT) FROM cats WHERE cnt / n < 0.005 GROUP BY 1)
        SELECT "column", anomalies, {pct('anomalies', '(SELECT count(*) FROM dirty)')} AS rate_pct FROM a WHERE anomalies > 0""",
    "median_impute": f"""{WITH}, s AS (SELECT * REPLACE ({_stripped_money('spesa')} AS spesa, {_stripped_money('quota')} AS quota) FROM dirty)
        SELECT * REPLACE (CAST(CAST(coalesce(spesa, (SELECT quantile_cont(spesa, 0.5) FROM s)) AS DECIMAL(38,2)) AS VARCHAR) AS spesa, CAST(CAST(quota AS DECIMAL(38,2)) AS VARCHAR) AS quota) FROM s""",
    "cap_p99": "SELECT event_id, round_even(least(value, (SELECT quantile_cont(value, 0.99) FROM events)), 4) AS value FROM events",
    "group_rare": f"""{WITH}, {_CATS}, rare AS (SELECT "column", value FROM cats WHERE cnt / n < 0.005 AND value IS NOT NULL) """
    + _table({c: f"""CASE WHEN {_id(c)} IN (SELECT value FROM rare WHERE "column" = '{c}') THEN 'Other' ELSE {_id(c)} END""" for c in COLUMNS}),
    "trim_text": f"{WITH} " + _table({c: strip(_id(c)) for c in COLUMNS}),
    "reliability_score": f"{_METRICS} SELECT *, {_GRADE} AS grade FROM scored",
    "documented_score": f"""{_METRICS}, s AS (SELECT type_issues, completeness_pct, format_issues, round_even(greatest(0, 100 - least((type_issues * 3 + naming_issues) * (10 / column_count), 20)
        - (100 - completeness_pct) * 0.5 - format_issues * 3 * (10 / column_count) - 5 - least(duplicate_rows / 100, 10) - outlier_penalty), 1) AS score FROM metrics)
        SELECT *, {_GRADE} AS grade FROM s""",
    "null_rate_score": f"""{WITH}, p AS (SELECT "column", count_if(value IS NULL) / count(*) AS p FROM cells GROUP BY 1),
        d AS (SELECT sum(CASE WHEN p > 0.2 THEN least(p * 20, 10) WHEN p > 0.05 THEN p * 5 ELSE 0 END + CASE WHEN p > 0.1 AND p < 1 AND NOT suffix("column", '_flag') THEN 1 ELSE 0 END) AS deduction FROM p)
        SELECT round_even(deduction, 4) AS deduction, greatest(0, round_even(100 - deduction, 1)) AS score,
        CASE WHEN round_even(100 - deduction, 1) >= 90 THEN 'A' WHEN round_even(100 - deduction, 1) >= 80 THEN 'B' WHEN round_even(100 - deduction, 1) >= 70 THEN 'C' WHEN round_even(100 - deduction, 1) >= 60 THEN 'D' ELSE 'F' END AS grade FROM d""",
    "suggestions": f"""{_METRICS} SELECT 1 AS place, 'all_text_columns' AS field, 'outer_blanks' AS issue, 'trim_text_columns' AS action, 0.97::DOUBLE AS confidence, 'low' AS risk, true AS auto_apply
        UNION ALL SELECT 2, 'column_names', 'names_not_snake_case', 'rename_to_snake_case', 0.95, 'low', true FROM metrics WHERE naming_issues > 0
        UNION ALL SELECT 3, 'rows', 'repeated_rows', 'drop_repeated_rows', 0.90, 'low', true FROM metrics WHERE duplicate_rows > 0
        UNION ALL SELECT 4, 'anomaly_columns', 'outliers_or_rare_values', 'cap_extremes_and_group_rare', 0.82, 'medium', false FROM metrics WHERE iqr_outliers > 0 OR rare_values > 0
        UNION ALL SELECT 5, 'missing_values', 'missing_cells', 'keep_nulls_and_flag_them', 0.92, 'low', true FROM metrics WHERE avg_missing_pct > 0""",
    "roadmap": f"{_METRICS}, {_ROADMAP} SELECT CAST(priority AS INT) AS priority, category, action, score_impact, difficulty, auto_applicable FROM steps",
    "expected_score": f"""{_METRICS}, {_ROADMAP} SELECT score, gain, least(100, round_even(score + gain, 1)) AS expected_score FROM scored, (SELECT sum(score_impact) AS gain FROM steps WHERE priority <= 3)""",
    "apply_suggestions": f"""{WITH} SELECT DISTINCT {', '.join(f"{strip(_id(c))} AS " + {"_id": "id", "SPESA TOTALE": "spesa_totale", "aggregation-time": "aggregation_time"}.get(c, c) for c in COLUMNS)} FROM dirty""",
    "text_figures": f"""WITH {_TEXTS} SELECT o_custkey, {_captured('text', 'Removed\\s+(\\d+)\\s+exact duplicate row')} + {_captured('text', '(\\d+)\\s+exact duplicates')} AS duplicate_rows,
        {_captured('text', '(\\d+)\\s+IQR outliers')} + {_captured('text', '(\\d+)\\s+outliers')} AS outliers,
        round_even(list_avg(list_transform(regexp_extract_all(text, '(?i)(\\d+(?:\\.\\d+)?)%\\s+missing', 1), lambda s: CAST(s AS DOUBLE))), 4) AS missing_pct,
        CAST(len(regexp_extract_all(text, '(?i)snake_case|uppercase|hyphen|naming')) AS INT) AS naming_hits, regexp_matches(text, '(?i)cross-column mismatch|inconsistent with') AS cross_column FROM texts""",
    "stated_scores": f"""WITH {_TEXTS} SELECT o_custkey, regexp_extract(text, '(?i)(?:score|punteggio)[^\\d]*(\\d{{1,3}}(?:\\.\\d+)?)\\s*/\\s*100', 1) AS score,
        regexp_extract(text, '(?i)\\bgrade[:\\s]+([A-F][+-]?)\\b', 1) AS grade, {_kept('text', _PREFIXES)} AS kept FROM texts""",
    "document_numbers": f"""SELECT doc_id, {_captured('text', '(\\d{1,6})\\s+[a-z]')} AS numbers, CAST(len(regexp_extract_all(text, '(?i)date|rare|type')) AS INT) AS hits,
        CAST(length({_kept('text', ('licensed',))}) AS INT) AS kept_chars FROM documents""",
    "pipeline_table": f"{_PIPELINE} SELECT * FROM v3",
    "before_after": f"""{_PIPELINE}, {_cells('v1', _V1_COLUMNS).replace('cells AS', 'cells1 AS')}, {_cells('v3', _V3_COLUMNS).replace('cells AS', 'cells3 AS')},
        {_NUMERIC.replace('FROM cells', 'FROM cells3')}, {_fences('xs')}, per_out AS ({_outliers('std', 'iqr_outliers > 0')}),
        miss AS (SELECT round_even(count_if({missing('value')}) * 100.0 / count(*), 2) AS p FROM cells1 GROUP BY "column"),
        s AS (SELECT round_even(100 - round_even(least((SELECT avg(p) FROM miss WHERE p > 0) * 0.4, 20), 1) - round_even(least(3 * (10 / {len(COLUMNS)}), 5), 1)
          - round_even(least(((SELECT count(*) FROM v2) - (SELECT count(*) FROM (SELECT DISTINCT * FROM v2))) / 100, 10), 1)
          - round_even(least((SELECT sum(iqr_outliers) FROM per_out) / 50, 10), 1) - 5, 1) AS score)
        SELECT (SELECT count(*) FROM dirty) AS original_rows, (SELECT count(*) FROM v3) AS fixed_rows, CAST({len(COLUMNS)} AS BIGINT) AS original_columns,
        CAST({len(_V3_COLUMNS)} AS BIGINT) AS fixed_columns, score, {_GRADE} AS grade FROM s""",
    "pipeline_log": f"""{_PIPELINE}, removed AS (SELECT (SELECT count(*) FROM v2) - (SELECT count(*) FROM v3) AS n)
        SELECT unnest([1, 2, 3, 4, 5]::BIGINT[]) AS step, unnest(['schema', 'completeness', 'consistency', 'anomaly', 'remediation']) AS stage, 'profile' AS reason,
        unnest([0, 0, n, 0, 0]::BIGINT[]) AS rows_removed, unnest([4, 0, 0, 0, 0]::BIGINT[]) AS types_changed FROM removed""",
}
