"""BPE encoding and decoding by forced boundaries.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can never be
merged across, so it marks a certain cut. Words are cut there, the distinct fragments of a
slice of texts are encoded once, each on its own, and the ids are put together again.

The merges of all fragments run side by side in numpy: each round, every fragment applies
its merge of lowest rank wherever it occurs, from left to right. That is the order of the
algorithm as every token is made by exactly one merge, which is checked when a vocabulary
is read.
"""

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from civiclens.llm.tables import read_table
from civiclens.llm.texts import distinct_spans, flat, ragged, release_memory, slices

# The endings that the vocabulary's pattern takes together with an apostrophe.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
_WORD_END = "</w>"
# White space by the Unicode property.
_WHITE = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B))
_WHITE += (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_NONE = np.int64(1 << 40)
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_BATCH_BYTES = 500_000


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class FragmentEncoder:
    """Encodes lists of texts with a word-end byte-level BPE vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocabulary = spec["model"], spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = {**vocabulary, **self.special}
        self.tokens = [""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.tokens[number] = token
        symbols = _byte_symbols()
        self.inner = np.array([vocabulary[s] for s in symbols])
        self.final = np.array([vocabulary[s + _WORD_END] for s in symbols])
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [vocabulary[a + b] for a, b in merges]
        if len(set(made)) != len(made):
            raise ValueError("a token is made by more than one merge")
        keys = np.array([vocabulary[a] << 20 | vocabulary[b] for a, b in merges])
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order, np.array(made)[order]
        self.joins = self._inside(symbols)
        self.classes = self._classes()

    def _inside(self, symbols: list[str]) -> np.ndarray:
        """Whether a pair of bytes occurs in a token: [0] before its end, [1] as the end of a word."""
        byte = {s: b for b, s in enumerate(symbols)}
        joins = np.zeros((2, 256, 256), bool)
        for token in self.tokens:
            if token in self.special:
                continue
            ends = token.endswith(_WORD_END)
            text = [byte[c] for c in token.removesuffix(_WORD_END)]
            for i in range(1, len(text)):
                joins[int(ends and i == len(text) - 1), text[i - 1], text[i]] = True
        return joins

    @staticmethod
    def _classes() -> np.ndarray:
        kinds = {"L": _LETTER, "N": _NUMBER}
        table = [kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)]
        for space in _WHITE:
            table[space] = _SPACE
        return np.array(table, np.uint8)

    @staticmethod
    def normalize(text: str) -> str:
        """Composed (NFC) and in lower case, each character for itself; white space stays."""
        return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()

    def _words(self, points: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Whether a word begins at each code point; white space makes words of its own."""
        begins = np.ones(len(points), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        for i in np.flatnonzero((points == 39) & begins):
            letters = "".join(map(chr, points[i + 1 : i + 3]))
            ending = next((e for e in _ENDINGS if letters.startswith(e)), None)
            if ending:
                begins[i + 1] = False
                begins[i + 1 + len(ending) : i + 2 + len(ending)] = True
        return begins

    def _encode_fragments(self, symbols: np.ndarray, owner: np.ndarray):
        """Merge until no pair has a rank. ``owner`` numbers the fragments in order from 0."""
        done = []
        while len(symbols):
            key = symbols[:-1] << 20 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.full(len(symbols), _NONE)
            rank[:-1][known] = self.ranks[at[known]]
            firsts = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(firsts, append=len(owner))
            best = np.repeat(np.minimum.reduceat(rank, firsts), sizes)
            over = best == _NONE
            if over.any():
                done.append((owner[over], symbols[over]))
                left = ~over
                symbols, owner, rank, best = symbols[left], owner[left], rank[left], best[left]
                made = np.zeros(len(left), np.int64)
                made[:-1] = self.made[at]
                made = made[left]
            else:
                made = np.append(self.made[at], 0)
            hit = rank == best
            # Of overlapping pairs (a a a), every second one is merged.
            run = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
            if len(run):
                index = np.flatnonzero(hit)
                start = run[np.searchsorted(run, index, "right") - 1]
                index = index[(index - start) % 2 == 0]
                symbols[index] = made[index]
                keep = np.ones(len(symbols), bool)
                keep[index + 1] = False
                symbols, owner = symbols[keep], owner[keep]
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner = np.concatenate([d[0] for d in done])
        symbols = np.concatenate([d[1] for d in done])
        order = np.argsort(owner, kind="stable")
        return symbols[order], owner[order]

    def _encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text starts."""
        texts = [self.normalize(text) for text in texts]
        joined = " ".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        data = np.frombuffer(joined.encode("utf-8"), np.uint8)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        begins = np.zeros(len(data) + 1, bool)
        kind = self.classes[points]
        begins[heads] = self._words(points, kind)
        begins[-1] = True
        blank = np.repeat(kind == _SPACE, np.diff(heads, append=len(data)))
        final = begins[1:]
        cut = begins[:-1].copy()
        cut[1:] |= ~self.joins[final[1:].astype(np.int64), data[:-1], data[1:]]
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        real = ~blank[starts]
        starts, ends = starts[real], ends[real]
        ids, counts = self._distinct(data, starts, ends, final)
        sizes = np.array([len(t.encode()) + 1 for t in texts], np.int64)
        texts_at = np.cumsum(sizes) - sizes
        tokens = np.append(0, np.cumsum(counts))
        return ids, np.append(tokens[np.searchsorted(starts, texts_at)], tokens[-1])

    def _distinct(self, data, starts, ends, final):
        """Ids of the fragments in order, and their number per fragment; each distinct one once."""
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ended = final[ends - 1]
        _, numbers = distinct_spans(data, starts, ends)
        _, first, which = np.unique(2 * numbers + ended, return_index=True, return_inverse=True)
        sizes = (ends - starts)[first]
        places = ragged(starts[first], sizes)
        owner = np.repeat(np.arange(len(first)), sizes)
        last = np.zeros(len(places), bool)
        last[np.cumsum(sizes) - 1] = ended[first]
        symbols = np.where(last, self.final[data[places]], self.inner[data[places]])
        pool, owner = self._encode_fragments(symbols, owner)
        counts = np.bincount(owner, minlength=len(first))
        offsets = np.cumsum(counts) - counts
        return pool[ragged(offsets[which], counts[which])], counts[which]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; special tokens spelled out in a text are taken as such."""
        plain, parts = [], []  # a text is a list of places in `plain` and of special ids
        for text in texts:
            part = []
            for piece in self._pieces(text):
                if piece in self.special:
                    part.append((None, self.special[piece]))
                else:
                    part.append((len(plain), None))
                    plain.append(piece)
            parts.append(part)
        ids, offsets = self._encode_plain(plain)
        out = []
        for part in parts:
            runs = [
                ids[offsets[at] : offsets[at + 1]] if special is None else np.array([special])
                for at, special in part
            ]
            out.append(runs[0] if len(runs) == 1 else np.concatenate(runs))
        return out

    def _pieces(self, text: str) -> list[str]:
        pieces = [text]
        for token in self.special:
            if token in text:
                pieces = [
                    p
                    for piece in pieces
                    for i, part in enumerate([piece] if piece in self.special else piece.split(token))
                    for p in ([token, part] if i else [part])
                ]
        return pieces

    def decode(self, ids: np.ndarray) -> str:
        """Tokens with a space between them, as for a vocabulary file without a decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids.tolist()])


def encoded(batch: pa.RecordBatch, encoder: FragmentEncoder) -> Iterator[tuple[int, np.ndarray]]:
    """Row and ids of every text of a batch of (id, text)."""
    texts = batch.column(1)
    _, offsets = flat(texts)
    for start, end in slices(offsets, _BATCH_BYTES):
        part = [text or "" for text in texts.slice(start, end - start).to_pylist()]
        yield from enumerate(encoder.encode(part), start)
    release_memory()


def encode_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    keep_ids: bool = True,
) -> DataFrame:
    """A row per document: its id, ``ids`` (unless ``keep_ids`` is off), ``n_tokens``,
    ``ids_sha256`` (ids as little-endian 32-bit numbers) and ``decoded_sha256``.

    A NULL or empty text has no ids, and decodes to the empty text. Repeated rows and
    rows with a NULL id are rows like others; any other columns are not looked at.
    """
    path = path or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = FragmentEncoder(path)
        for batch in batches:
            rows = []
            for row, ids in encoded(batch, encoder):
                packed = ids.astype("<u4")
                rows.append(
                    (
                        packed if keep_ids else None,
                        len(ids),
                        hashlib.sha256(packed.tobytes()).hexdigest(),
                        hashlib.sha256(encoder.decode(ids).encode()).hexdigest(),
                    )
                )
            columns = list(zip(*rows)) or [[], [], [], []]
            kinds = [pa.list_(pa.int32()), pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            names = ["ids", "n_tokens", "ids_sha256", "decoded_sha256"]
            kept = slice(0 if keep_ids else 1, None)
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays[kept]], [id_column, *names[kept]])

    kind = docs.schema[id_column].dataType.simpleString()
    ids = "ids array<int>, " if keep_ids else ""
    return docs.select(id_column, text_column).mapInArrow(
        encode,
        f"`{id_column}` {kind}, {ids}n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )


def op7_forced_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), keep_ids=False)
