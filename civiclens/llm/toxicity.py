"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of toxic and one on windows of
ordinary texts. A window (a run of words) is compressed with the ordinary dictionary, and
with the toxic one laid over it. As both share the ordinary background, the bytes that the
second saves measure what the window has in common with toxic text alone. The savings of all
windows of a text, by their log odds, become a score that is calibrated on texts of which
the dictionaries have seen nothing.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.tables import fold, read_table

WINDOW_WORDS = 16
# The toxic dictionary is larger if its words need it.
TOXIC_BYTES = 512
ORDINARY_BYTES = 16_384
LEVEL = 9
# At most so many labelled rows of each kind are learned from, none longer than this.
SAMPLE_ROWS = 2_000
SAMPLE_TEXT_BYTES = 30_000
_DICTIONARY_SHARE = 0.6
_DICTIONARY_TABLES = 512
_GAINS = 5
_TOLD_APART = 4
_CHANCE = 100
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class ToxicityModel:
    """Dictionaries, log odds per saving, and the calibration: weights of the two features and bias."""

    ordinary: bytes
    combined: bytes
    log_odds: tuple[float, ...]
    weights: tuple[float, float, float]
    level: int = LEVEL
    window_words: int = WINDOW_WORDS


def windows(text: str, size: int) -> list[bytes]:
    """Whole text in lower case, in runs of ``size`` words; white space counts as one space."""
    words = _WORDS.findall(text.lower().encode("utf-8", "replace"))
    return [b" ".join(words[i : i + size]) for i in range(0, len(words), size)]


class Scorer:
    """Scores texts under a model; made once in a task."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.compressors = [self._compressor(d) for d in (model.ordinary, model.combined)]

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        shared = zstandard.ZstdCompressionDict(content, zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=self.model.level)
        return zstandard.ZstdCompressor(
            self.model.level, dict_data=shared,
            write_content_size=False, write_dict_id=False, write_checksum=False,
        )

    def gains(self, text: str) -> np.ndarray:
        """Windows per saving of 0, 1, 2, 3 and more bytes; an empty text is one window that saves none."""
        ordinary, combined = (c.compress for c in self.compressors)
        counts = np.zeros(_GAINS)
        for window in windows(text, self.model.window_words) or [b""]:
            saved = len(ordinary(window)) - len(combined(window))
            counts[min(max(saved, 0), _GAINS - 1)] += 1
        return counts

    def score(self, text: str | None) -> float:
        features = _features(self.gains(text or ""), np.array(self.model.log_odds))
        return float(_sigmoid(features @ np.array(self.model.weights)))


def _features(counts: np.ndarray, log_odds: np.ndarray) -> np.ndarray:
    """Mean log odds of the windows, the same with more weight if there are many, and 1."""
    total = counts.sum(axis=-1)
    mean = counts @ log_odds / np.maximum(total, 1)
    return np.stack([mean, mean * np.sqrt(total) / 4, np.ones_like(mean)], axis=-1)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(
    texts: list[str], toxic: list[bool], totals: tuple[int, int] | None = None
) -> ToxicityModel | None:
    """A model from labelled texts; None unless there are a few of both kinds.

    ``totals`` has the ordinary and the toxic rows that the texts are a sample of. The
    calibration weighs the texts by them, so that a score does not depend on the mix of the sample.
    """
    y = np.array(toxic, bool)
    if min(y.sum(), (~y).sum()) < 2:
        return None
    learn = np.zeros(len(y), bool)  # these make the dictionaries, the others the calibration
    for kind in (y, ~y):
        rows = np.flatnonzero(kind)
        learn[rows[: max(1, int(len(rows) * _DICTIONARY_SHARE))]] = True
    learned = [[windows(texts[i], WINDOW_WORDS) for i in np.flatnonzero(learn & k)] for k in (y, ~y)]
    toxic_part = _toxic_part(*learned)
    ordinary = _dictionary([w for text in learned[1] for w in text], ORDINARY_BYTES, segment=200, match=8)
    flat_odds = (0.0, *np.linspace(0.5, 2, _GAINS - 1))
    draft = ToxicityModel(ordinary, toxic_part + ordinary, flat_odds, (1.0, 0.0, 0.0))
    scorer = Scorer(draft)
    rest = np.flatnonzero(~learn)
    counts = np.array([scorer.gains(texts[i]) for i in rest])
    share = [(counts[y[rest] == k].sum(axis=0) + 1) for k in (True, False)]
    log_odds = np.log(share[0] / share[0].sum()) - np.log(share[1] / share[1].sum())
    of_kind = [n / k.sum() for n, k in zip(totals or ((~y).sum(), y.sum()), (~y, y))]
    stands_for = np.where(y[rest], of_kind[1], of_kind[0])
    weights = _fit(_features(counts, log_odds), y[rest].astype(float), stands_for)
    return ToxicityModel(ordinary, toxic_part + ordinary, tuple(log_odds), tuple(weights))


def _told_apart(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> tuple[list[bytes], set[bytes]]:
    """Windows of the toxic texts less the words that tell nothing, and the words left.

    What stays are words that a larger share of the toxic texts use, more than chance would have
    it: going by the ordinary texts, a word of all would be kept by chance once in a hundred times. A word is
    judged by itself, so one that is rare but told apart stays beside frequent ones. Copies of a
    text add no context (neighbouring words), and a text that uses a word often counts once.
    A dictionary of whole windows would mostly hold the common background.
    """
    of = [_contexts(texts) for texts in (toxic, ordinary)]
    rate = of[0].total() / max(of[1].total(), 1)
    share = rate / (1 + rate)
    least = np.log(_CHANCE * max(len(of[0]), 1))

    def surprise(uses: int, others: int) -> float:
        """Bound on -log of the chance of so many of all uses in toxic texts (Chernoff)."""
        seen = uses / (uses + others)
        rest = others * np.log((1 - seen) / (1 - share)) if others else 0.0
        return uses * np.log(seen / share) + rest

    def told(word: bytes, uses: int) -> bool:
        others = of[1][word]
        return uses > _TOLD_APART * rate * (others + 0.5) and surprise(uses, others) > least

    kept = {word for word, uses in of[0].items() if told(word, uses)}
    left = [b" ".join(w for w in window.split(b" ") if w in kept) for text in toxic for window in text]
    return [b" " + window + b" " for window in left if window], kept


def _contexts(texts: list[list[bytes]]) -> Counter:
    """Texts per word that bring a pair of neighbours of it not seen before."""
    seen, uses = set(), Counter()
    for text in texts:
        words, fresh = b" ".join(text).split(b" "), set()
        for context in zip([b"", *words], words, [*words[1:], b""]):
            key = hash(context)
            if key not in seen:
                seen.add(key)
                fresh.add(context[1])
        uses.update(fresh)
    return uses


def _toxic_part(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> bytes:
    """Dictionary with every word that tells toxic texts apart, as large as these need it to be."""
    left, kept = _told_apart(toxic, ordinary)
    size = max(TOXIC_BYTES, sum(len(word) + 2 for word in kept))
    trained = _dictionary(left, size, segment=16, match=6)
    # What training left out for want of room or of uses goes first.
    missing = [word for word in sorted(kept) if b" " + word + b" " not in trained]
    return b"".join(b" " + word + b" " for word in missing) + trained


def _dictionary(samples: list[bytes], size: int, segment: int, match: int) -> bytes:
    """Content of a trained dictionary; where too little text is there to train one, the text."""
    try:
        # The best segments come last; what comes first are tables for another use.
        room = size + _DICTIONARY_TABLES
        trained = zstandard.train_dictionary(room, samples, k=segment, d=match).as_bytes()
    except (zstandard.ZstdError, ValueError):
        trained = b" ".join(samples)
    return trained[-size:].rjust(8)


def _fit(x: np.ndarray, y: np.ndarray, stands_for: np.ndarray) -> np.ndarray:
    """Logistic regression with a small penalty, by Newton's method; a row counts as so many."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ w)
        gradient = x.T @ (stands_for * (p - y)) + 0.01 * w
        w -= np.linalg.solve((x * (stands_for * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w)), gradient)
    return w


def train_on(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", sample_rows: int = SAMPLE_ROWS,
) -> ToxicityModel | None:
    """Learn from up to ``sample_rows`` labelled rows of each kind outside fold 0, by hash order.

    Rows without an id, text or label, and texts over ``SAMPLE_TEXT_BYTES``, are not learned from, nor are
    ids with both labels. An id may have several texts; rows that repeat are learned once.
    All rows of each kind that could be are counted, as the sample has another mix.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"))
    known = known.filter((fold("id") != 0) & F.col("id").isNotNull() & F.col("label").isin(0, 1))
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    known = known.filter("label = other").drop("other")
    picked = None
    for kind in (0, 1):
        some = known.filter(F.col("label") == kind).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    texts = texts.filter(F.octet_length("text") <= SAMPLE_TEXT_BYTES)
    found = texts.join(F.broadcast(picked), "id").distinct()
    by_hash = [F.xxhash64("id", "text"), "id", F.md5("text")]
    rows = [
        row
        for kind in (0, 1)
        for row in found.filter(F.col("label") == kind).orderBy(*by_hash).limit(sample_rows).collect()
    ]
    rows.sort(key=lambda row: (zlib.crc32(f"{row['id']}/".encode()), row["text"], row["label"]))
    counts = dict(texts.select("id").join(known, "id").groupBy("label").count().collect())
    toxic = [row["label"] == 1 for row in rows]
    return train([row["text"] for row in rows], toxic, (counts.get(0, 0), counts.get(1, 0)))


def score_documents(
    docs: DataFrame, model: ToxicityModel | None, text_column: str = "text", score_column: str = "score"
) -> DataFrame:
    """``docs`` with a score from 0 to 1 in a further column (a column of that name is replaced).

    Only the whole text decides; NULL counts as empty, and both get the score of a window
    that saves nothing. Without a model every score is 0.
    """
    columns = [F.col(f"`{name}`") for name in docs.columns if name != score_column]
    return docs.select(*columns, _scores(model)(F.col(text_column)).alias(score_column))


def _scores(model: ToxicityModel | None):
    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = model and Scorer(model)
        for batch in texts:
            yield pa.array(
                [scorer.score(t.as_py()) if scorer else 0.0 for t in batch], pa.float64()
            )

    return score


def op9_compression_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train_on(docs, read_table(spark, sf_dir, "labels"))
    scored = score_documents(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (fold() == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
