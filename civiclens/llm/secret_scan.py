"""Secrets in texts: keywords by Aho-Corasick, anchored patterns at their hits, checksums.

One automaton holds the keywords of all kinds that start with one, another the shortest run of
hexadecimal digits. They read the bytes of a text, folded so that a keyword stands for all its
spellings; patterns are tried at hits only, from left to right. A hit within the last match of its
kind is passed over, so matches are leftmost and do not overlap, as if the pattern had been tried
everywhere: every match begins with a keyword, and no keyword begins another.

Tokens that carry a checksum (the last six characters are the CRC-32 of those before in base 62)
are found by their prefixes and kept only if it is right.
"""

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from civiclens.llm.tables import read_table
from civiclens.llm.texts import flat, lower_ascii

# Kinds in the order of their spans, and the patterns, least lengths and keywords.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm")
_ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = rb"AKIA[A-Z0-9]+"
_HEX = rb"[0-9a-f]+"
_ASSIGN_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_LEAST_VALUE, _LEAST_ACCESS, _LEAST_HEX = 8, 16, 32
_CHECKED = {"github": rb"gh[opsur]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])",
            "npm": rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"}
_CHECKED_KEYWORDS = {"github": ("gho_", "ghp_", "ghs_", "ghu_", "ghr_"), "npm": ("npm_",)}
_DIGITS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum(body: bytes) -> bytes:
    """The six characters that end a token with this body."""
    left, out = zlib.crc32(body), b""
    for _ in range(6):
        left, digit = divmod(left, 62)
        out = _DIGITS[digit : digit + 1] + out
    return out


def _assigned(match: re.Match) -> bool:
    return match.end(2) - match.start(2) >= _LEAST_VALUE


def _long_enough(match: re.Match) -> bool:
    return match.end() - match.start() >= _LEAST_ACCESS


def _checked(match: re.Match) -> bool:
    return checksum(match[1]) == match[2]


class Scanner:
    """Finds the spans of all kinds in one text at a time."""

    def __init__(self):
        import ahocorasick

        self.keywords = ahocorasick.Automaton()
        # A keyword may be that of several kinds, by its spelling in lower case.
        kinds: dict[str, list[str]] = {k: ["assign"] for k in _ASSIGN_KEYWORDS}
        kinds.setdefault("akia", []).append("access")
        for kind, keywords in _CHECKED_KEYWORDS.items():
            for keyword in keywords:
                kinds.setdefault(keyword, []).append(kind)
        for keyword, named in kinds.items():
            self.keywords.add_word(keyword, (len(keyword), named))
        self.keywords.make_automaton()
        self.run = ahocorasick.Automaton()
        self.run.add_word("0" * _LEAST_HEX, _LEAST_HEX)
        self.run.make_automaton()
        self.patterns = {
            "assign": (re.compile(_ASSIGN, re.IGNORECASE), _assigned),
            "access": (re.compile(_ACCESS), _long_enough),
            **{kind: (re.compile(p), _checked) for kind, p in _CHECKED.items()},
        }
        self.hex = re.compile(_HEX)
        self.folds = np.arange(256, dtype=np.uint8)
        self.folds[list(b"0123456789abcdef")] = 48

    def spans(self, data: np.ndarray) -> list[tuple[str, int, int]]:
        """(kind, start, end) by start and kind, in bytes of the UTF-8 text."""
        whole, found = data.tobytes(), []
        ends = dict.fromkeys(KINDS, 0)
        for last, (length, kinds) in self.keywords.iter(lower_ascii(data).tobytes().decode("latin-1")):
            start = last - length + 1
            for kind in kinds:
                pattern, valid = self.patterns[kind]
                match = pattern.match(whole, start) if start >= ends[kind] else None
                if match:
                    ends[kind] = match.end()
                    if valid(match):
                        found.append((kind, start, match.end()))
        for last, length in self.run.iter(self.folds[data].tobytes().decode("latin-1")):
            start = last - length + 1
            if start >= ends["hex"]:
                ends["hex"] = self.hex.match(whole, start).end()
                found.append(("hex", start, ends["hex"]))
        return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
        """Counts of the base kinds, digest of their spans and all spans, per text, in code points."""
        for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            text = data[start:end]
            spans = self.spans(text)
            if spans:
                heads = np.cumsum((text & 0xC0) != 0x80)  # code points up to each byte
                points = np.append(0, heads)
                spans = [(kind, int(points[a]), int(points[b])) for kind, a, b in spans]
            named = [(kind, f"{kind}:{a}:{b}") for kind, a, b in spans]
            base = ",".join(name for kind, name in named if kind in BASE)
            counts = [sum(kind == one for kind, _ in named) for one in BASE]
            yield (*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(n for _, n in named))


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per document: its id, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans``.

    A span is ``kind:start:end`` in code points, the end exclusive; spans are joined by commas, by
    start and then in the order of ``KINDS``. ``base_sha256`` is the digest of those of the three base
    kinds, ``spans`` names the tokens with a right checksum as well. NULL is an empty text, without
    spans. Repeated rows and rows with a NULL id are rows like others; any other columns are not
    looked at. An empty table gives no rows. Each text is read by itself and in linear time.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            columns = list(zip(*scanner.rows(*flat(batch.column(1))))) or [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            names = [id_column, "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        scan,
        f"`{id_column}` {kind}, n_assign bigint, n_access bigint, n_hex bigint, "
        "base_sha256 string, spans string",
    )


def op11_keyword_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read_table(spark, sf_dir, "documents"))
