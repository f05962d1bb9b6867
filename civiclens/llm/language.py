"""Language identification: averaged embeddings of hashed subwords under a linear softmax.

A text is its letters in lower case, every other run of characters being one boundary. Its
subwords are all runs of one to four characters, boundaries included, hashed to a table of
embeddings. Their average goes through a linear layer and a softmax. Embeddings and layer are
learned by stochastic gradient descent in numpy, and a temperature and thresholds for
rejection are set on texts that were kept out of the descent: short texts are less sure, so
there is a threshold per length.
"""

import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclens.llm.tables import fold, read_table
from civiclens.llm.texts import flat, mix, slices

BUCKETS = 1 << 14
DIMENSIONS = 16
LONGEST = 4
UNKNOWN = "und"
# At most so many labelled rows are learned from, none longer than this.
SAMPLE_ROWS = 1_000
# And of each language at least so many, if it has them; fewer of more than 20 languages.
RARE_ROWS = 50
_RARE_LEAST = 5
# The languages with the most rows that are learned, of any number of names in the column.
MOST_LANGUAGES = 200
SAMPLE_TEXT_BYTES = 50_000
# Share of the right predictions on texts kept out that rejection may cost.
REJECTED_RIGHT = 0.0005
_PIECES = 12
_RUNS = 4
_LONGEST_RUN = 256
_PER_LENGTH = 500
_TUNED = 200
_EPOCHS = 30
_BATCH = 32
_RATE = 2.0
_TUNING = 0.25


@dataclass(frozen=True)
class LanguageModel:
    """``table`` has the score of each language per bucket: embeddings times layer."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    # The lengths in letters from which on a threshold holds, and the thresholds.
    lengths: tuple[int, ...]
    thresholds: tuple[float, ...]

    def threshold(self, letters: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.lengths, letters, side="right") - 1
        return np.array(self.thresholds)[np.maximum(at, 0)]


class Subwords:
    """Letters and hashed subwords of many texts at a time."""

    def __init__(self, buckets: int = BUCKETS):
        self.mask = np.uint64(buckets - 1)
        points = range(0x40000)  # beyond these planes there are no letters
        letters = np.array([unicodedata.category(chr(c))[0] == "L" for c in points])
        lower = np.array([ord(low) if len(low := chr(c).lower()) == 1 else c for c in points])
        self.code = np.where(letters, lower, 0).astype(np.uint32)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of all subwords, the text each belongs to, and the letters per text."""
        joined = "\n".join(["", *texts, ""])
        points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        code = self.code[np.minimum(points, len(self.code) - 1)]
        sizes = np.array([len(t) + 1 for t in texts])
        owner = np.zeros(len(points), np.int64)
        owner[1:] = np.repeat(np.arange(len(texts)), sizes)
        letters = np.bincount(owner[code > 0], minlength=len(texts))
        kept = np.ones(len(code), bool)  # of a run of other characters, one is the boundary
        kept[1:] = (code[1:] > 0) | (code[:-1] > 0)
        code, owner = code[kept].astype(np.uint64), owner[kept]
        buckets, owners = [], []
        value = np.zeros(len(code), np.uint64)
        whole = np.ones(len(code), bool)
        for size in range(1, LONGEST + 1):
            step = code[size - 1 :]
            value = value[: len(step)] * np.uint64(0x9E3779B97F4A7C15) + step + np.uint64(1)
            if size > 2:  # boundaries only at the ends
                whole = whole[: len(step)] & (code[size - 2 : len(code) - 1] > 0)
            else:
                whole = whole[: len(step)]
            real = whole & ((size > 2) | (step > 0) | (code[: len(step)] > 0))
            buckets.append((mix(value[real]) & self.mask).astype(np.int64))
            owners.append(owner[size - 1 :][real])
        return np.concatenate(buckets), np.concatenate(owners), letters


def train(texts: list[str], languages: list[str]) -> LanguageModel | None:
    """A model of the languages given; None without any text that has a letter."""
    subwords = Subwords()
    kinds = sorted(set(languages))
    x = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in enumerate(texts):
        x[row] = np.bincount(subwords.of([text])[0], minlength=BUCKETS)
    some = x.sum(axis=1) > 0
    y = np.array([kinds.index(k) for k in languages], int)
    if not some.all():
        x, y = x[some], y[some]
    if not len(x):
        return None
    x /= x.sum(axis=1, keepdims=True)
    tuning = np.arange(len(x)) >= max(1, int(len(x) * (1 - _TUNING)))
    embeddings, layer, bias = _descend(x, y, np.flatnonzero(~tuning), len(kinds))
    embeddings[x[: np.count_nonzero(~tuning)].sum(axis=0) == 0] = 0  # never seen, so they say nothing
    table = embeddings @ layer
    if not tuning.any():
        tuning = ~tuning
    logits = x[tuning] @ table + bias
    kept = [text for text, real in zip(texts, some) if real]
    tuned = [kept[i] for i in np.flatnonzero(tuning)][:_TUNED]
    short, short_y = _short_pieces(subwords, tuned, y[tuning], table)
    temperature = _temperature(np.concatenate([logits, short + bias]), np.concatenate([y[tuning], short_y]))
    draft = LanguageModel(kinds, table.astype(np.float32), bias, temperature, (0,), (0.0,))
    lengths, sure = [], []
    for n, i in enumerate(np.flatnonzero(tuning)):
        pieces = [kept[i], *(_runs(kept[i]) if n < _TUNED else [])]
        pred, score, letters = _predict(draft, subwords, pieces)
        right = np.array([kind == kinds[y[i]] for kind in pred])
        lengths += letters[right].tolist()
        sure += np.array(score)[right].tolist()
    return replace(draft, **_thresholds(np.array(lengths, int), np.array(sure)))


def _runs(text: str) -> list[str]:
    """Runs of 1, 2, 4 and more words, some of each length, spread over the text."""
    words, runs, size = text.split(), [], 1
    while size < len(words) and size <= _LONGEST_RUN:
        starts = sorted({i * (len(words) - size) // (_RUNS - 1) for i in range(_RUNS)})
        runs += [" ".join(words[start : start + size]) for start in starts]
        size *= 2
    return runs


def _thresholds(lengths: np.ndarray, sure: np.ndarray) -> dict:
    """Thresholds for doubling lengths, each from ``_PER_LENGTH`` right predictions or more.

    A length with fewer is taken together with the next shorter ones; what is left of the shortest
    is judged by all.
    """
    found, at = [], np.log2(np.maximum(lengths, 1)).astype(int)
    taken = np.zeros(len(at), bool)
    for low in sorted(set(at.tolist()), reverse=True):
        taken |= at == low
        if taken.sum() >= _PER_LENGTH:
            found.append((2**low, float(np.quantile(sure[taken], REJECTED_RIGHT))))
            taken[:] = False
            at[at >= low] = -1
    if taken.any() or not found:
        found.append((0, float(np.quantile(sure, REJECTED_RIGHT)) if len(sure) else 0.0))
    found.reverse()
    return {"lengths": tuple(low for low, _ in found), "thresholds": tuple(least for _, least in found)}


def _short_pieces(subwords: Subwords, texts: list[str], y: np.ndarray, table: np.ndarray):
    """Mean scores of runs of one to four words, spread over each text, and their languages."""
    pieces, kinds = [], []
    for text, kind in zip(texts, y):
        words = text.split()
        for i in range(min(_PIECES, len(words))):
            start = i * len(words) // _PIECES
            buckets = subwords.of([" ".join(words[start : start + 1 + i % 4])])[0]
            if len(buckets):
                pieces.append(table[buckets].mean(axis=0))
                kinds.append(kind)
    return np.array(pieces, float).reshape(-1, table.shape[1]), np.array(kinds, int)


def _descend(x: np.ndarray, y: np.ndarray, learned: np.ndarray, kinds: int):
    random = np.random.default_rng(11)
    embeddings = random.normal(0, 0.1, (x.shape[1], DIMENSIONS)).astype(np.float32)
    layer = random.normal(0, 0.1, (DIMENSIONS, kinds)).astype(np.float32)
    bias = np.zeros(kinds, np.float32)
    for epoch in range(_EPOCHS):
        rate = _RATE * (1 - epoch / _EPOCHS)
        order = random.permutation(learned)
        for start in range(0, len(order), _BATCH):
            rows = order[start : start + _BATCH]
            averaged = x[rows] @ embeddings
            error = _softmax(averaged @ layer + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            back = error @ layer.T
            layer -= rate * averaged.T @ error
            bias -= rate * error.sum(axis=0)
            embeddings -= rate * 20 * (x[rows].T @ back)
    return embeddings, layer, bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The one under which the texts kept out are likeliest."""
    choices = np.geomspace(0.02, 20, 61)
    losses = [-np.log(_softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in choices]
    return float(choices[int(np.argmin(losses))])


def train_on(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    lang_column: str = "lang", sample_rows: int = SAMPLE_ROWS,
) -> LanguageModel | None:
    """Learn from up to ``sample_rows`` rows outside fold 0 that have a text and a language.

    They are chosen by the hash of id and text; texts over ``SAMPLE_TEXT_BYTES`` are not learned from.
    Of each language at least the first ``RARE_ROWS`` are among them, of many languages
    ``sample_rows`` for all, but no fewer than ``_RARE_LEAST`` each. Of over ``MOST_LANGUAGES`` names, those
    with the most rows are learned. An id may have several texts; rows that repeat count in the bounds, and
    are learned once.
    """
    known = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    ).filter((fold("id") != 0) & (F.octet_length("text") <= SAMPLE_TEXT_BYTES) & F.col("lang").isNotNull())
    known = known.filter((F.col("lang") != UNKNOWN) & F.col("id").isNotNull())
    most = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    languages = [row["lang"] for row in most.collect()]
    known = known.filter(F.col("lang").isin(*languages)) if languages else known.limit(0)
    each = max(_RARE_LEAST, min(RARE_ROWS, sample_rows // max(1, len(languages))))
    by_hash = [F.xxhash64("id", "text"), "id", F.md5("text")]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*by_hash))
    first = known.withColumn("rank", rank).filter(F.col("rank") <= each).drop("rank")
    some = known.orderBy(*by_hash, "lang").limit(sample_rows)
    rows = some.unionByName(first).distinct().collect()
    rows.sort(key=lambda row: (zlib.crc32(f"{row['id']}/".encode()), row["text"], row["lang"]))
    return train([row["text"] for row in rows], [row["lang"] for row in rows])


def identify(
    docs: DataFrame, model: LanguageModel | None, text_column: str = "text", prefix: str = "lang_"
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` (0 to 1) and ``lang_accepted`` added.

    Only the whole text decides. NULL, or a text without a letter, is ``und`` with score 0 and
    not accepted; so is everything without a model. Columns of these names are replaced.
    """
    added = [prefix + name for name in ("pred", "score", "accepted")]
    found = F.inline(F.array(_identifier(model)(F.col(text_column)))).alias(*added)
    return docs.select(*[F.col(f"`{name}`") for name in docs.columns if name not in added], found)


def _identifier(model: LanguageModel | None):
    @F.arrow_udf("pred string, score double, accepted boolean")
    def identified(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        subwords = Subwords()
        for texts in columns:
            preds, scores, lengths = [], [], []
            _, offsets = flat(texts)
            for start, end in slices(offsets):
                part = [t or "" for t in texts.slice(start, end - start).to_pylist()]
                got = _predict(model, subwords, part)
                preds += got[0]
                scores += got[1]
                lengths += got[2].tolist()
            least = model.threshold(np.array(lengths, int)).tolist() if model else [1.0] * len(preds)
            accepted = [p != UNKNOWN and s >= t for p, s, t in zip(preds, scores, least)]
            arrays = [pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.StructArray.from_arrays(arrays, ["pred", "score", "accepted"])

    return identified


def _predict(model: LanguageModel | None, subwords: Subwords, texts: list[str]):
    if model is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), np.zeros(len(texts), int)
    buckets, owner, letters = subwords.of(texts)
    counts = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
    sums = [np.bincount(owner, column[buckets], len(texts)) for column in model.table.T.astype(float)]
    chance = _softmax((np.stack(sums, 1) / counts[:, None] + model.bias) / model.temperature)
    best = chance.argmax(axis=1)
    pred = [model.languages[b] if n else UNKNOWN for b, n in zip(best, letters)]
    return pred, np.where(letters > 0, chance.max(axis=1), 0.0).tolist(), letters


def op1_subword_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    named = identify(docs.select("doc_id", "text"), train_on(docs))
    return named.select(
        "doc_id", (fold() == 0).alias("held_out"), "lang_pred",
        F.col("lang_score").alias("score"), F.col("lang_accepted").alias("accepted"),
    )
