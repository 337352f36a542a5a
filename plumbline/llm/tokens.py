"""Token ids of a byte-level BPE vocabulary, as ``tokenizers`` gives them.

``tokenizers`` spends most of its time on building encodings with offsets. Where a text holds no special string, its
result is a function of the vocabulary and the pre-token pattern alone, and ``tiktoken`` computes the same ids from the
same file several times faster; the tests compare the two on every code point. Texts with special strings, and
vocabularies that are not plain byte-level BPE in merge order, go to ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

# The pre-token pattern of byte-level BPE; and the same where no white space follows white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SINGLE_SPACES = r"'(?:[stmd]|re|ve|ll)| ?(?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)|\s"
_RARE_SPACE = re.compile("[" + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]")


def _byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in the vocabulary file: printable Latin-1 stands for itself, the rest follow
    from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def runs_of_space(text: str) -> bool:
    """True if white space may follow white space."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return True
    if "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text:
        return True
    return not text.isascii() and _RARE_SPACE.search(text) is not None


class ByteBpe:
    """Encoder for one vocabulary file. ``ids(text)`` has no begin, end or padding tokens; special strings inside a text
    become their special ids, as the library does by default."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.fast = self.full = None
        if _is_plain(spec):
            import tiktoken

            letters = _byte_letters()
            ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
            self.full = tiktoken.Encoding("full", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.fast = tiktoken.Encoding("fast", pat_str=_SINGLE_SPACES, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.full is None or any(s in text for s in self.special):
            return self.exact.encode(text, add_special_tokens=False).ids
        return (self.full if runs_of_space(text) else self.fast).encode_ordinary(text)


def _is_plain(spec: dict) -> bool:
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return False
    if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return False
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    return all(model["vocab"].get(m) == 256 + i for i, m in enumerate(merged))


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    """One encoder per worker process and file."""
    return ByteBpe(path)
