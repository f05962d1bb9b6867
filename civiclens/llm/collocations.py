"""Collocations by multikey three-way quicksort of suffixes of words.

A suffix is a word and those that follow it in its piece, up to the longest phrase. Tasks fold equal
suffixes of a slice of text to one with a weight and route them by the hash of their leading
two words (words by themselves by their own), packed. Where a route ends, suffix pointers are sorted by
multikey quicksort: a partition is split three ways around a pivot's word at its depth, into
smaller, equal and larger, and only the equal part goes on to the next depth. The weight of an equal
part is the count of its phrase, and a part below the least count is abandoned, as no phrase
in it can reach it. All parts are split side by side in numpy, and none is ever sorted to its end.

A pair that holds over 1/500 of all suffixes is routed by all of its words instead, once each
task has counted it. So no key is more than a small part of a task's work, whatever the text.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclens.llm.tables import read_table, written
from civiclens.llm.texts import flat, lower_ascii, mix, release_memory, slices

LONGEST = 3
LEAST = 10
PERCENT = 50
TOP = 2000
SCALE = 1_000_000
# Bytes between pieces and between words, and the name of no language.
_BORDERS = (*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D)
_BLANKS = (0x20, 0x09)
_NO_LANGUAGE = "und"
_SLICE_BYTES = 3_000_000
_BUCKET_BYTES = 4_000_000
_CHUNK = 400_000  # suffixes that are sorted together
_HOT_SHARE = 500
_PARTS = 512
_PACKED = "bucket bigint, lang string, suffixes binary, n bigint"
# Rows that are no suffixes: words of a slice, pairs with many suffixes in it.
_WORDS, _HEAVY = -1, -2
_SPREAD, _ROUTES = 1 << 32, 1 << 20
_WEIGHT, _ONE = 0xFFFFFFFF, np.zeros(1, np.int64)


def _table(values) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


_IS_BORDER, _IS_GAP = _table(_BORDERS), _table((*_BORDERS, *_BLANKS))


def _parts(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Runs of whole rows of about ``size`` bytes (bytes, offsets, first row). A longer row is cut where
    a piece ends."""
    for start, end in slices(offsets, size):
        low, high = int(offsets[start]), int(offsets[end])
        while high - low > size and end - start == 1:
            borders = np.flatnonzero(_IS_BORDER[data[low : low + size]])
            if len(borders):
                cut = low + int(borders[-1]) + 1
            else:
                later = np.flatnonzero(_IS_BORDER[data[low + size : high]])
                cut = low + size + int(later[0]) + 1 if len(later) else high
            yield data[low:cut], np.array([0, cut - low]), start
            low = cut
        if end - start == 1:
            yield data[low:high], np.array([0, high - low]), start
        else:
            yield data[low:high], offsets[start : end + 1] - low, start


def _words(data: np.ndarray, offsets: np.ndarray):
    """Words of the rows, each followed by a blank, as an Arrow array; their rows and pieces."""
    data = np.insert(lower_ascii(data), offsets[1:], 0x0A)  # a border after each row
    gap, border = _IS_GAP[data], _IS_BORDER[data]
    ends = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1
    kept = ~gap
    kept[ends] = True  # the byte after a word, as its blank
    bytes_ = np.where(gap, np.uint8(0x20), data)[kept]
    places = np.append(0, np.cumsum(kept)[ends]) if len(ends) else np.zeros(1, np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(bytes_)]
    )
    rows = np.searchsorted(offsets[1:] + np.arange(len(offsets) - 1), ends, "left")
    return words, rows, np.cumsum(border)[ends - 1]


def _numbers(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct values and the number of each."""
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _hashes(words: pa.Array) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()], np.uint64)


class Packer:
    """Packs suffixes of a language for their buckets: lengths, weights and words, compressed."""

    def __init__(self):
        import zstandard

        self.compressor = zstandard.ZstdCompressor(level=1)
        self.decompressor = zstandard.ZstdDecompressor()

    def pack(self, lengths: np.ndarray, weights: np.ndarray, words: bytes) -> bytes:
        head = lengths.astype(np.uint8).tobytes() + weights.astype("<u4").tobytes()
        return self.compressor.compress(head + words)

    def unpack(self, packed: bytes, n: int) -> tuple[np.ndarray, np.ndarray, bytes]:
        whole = self.decompressor.decompress(packed)
        return np.frombuffer(whole, np.uint8, n), np.frombuffer(whole, "<u4", n, n), whole[5 * n :]

    def rows(self, names, ids: np.ndarray, weights: np.ndarray, bucket: np.ndarray, lang: np.ndarray, langs):
        """Packed rows of suffixes, given by numbers of their words (-1: none) and sorted by bucket."""
        lengths = (ids >= 0).sum(axis=0)
        flat_ids = ids.T[ids.T >= 0]
        words = names.take(pa.array(flat_ids))
        places = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
        data = words.buffers()[2]
        first = np.append(0, np.cumsum(lengths))
        group = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(lang) != 0)) + 1
        group = np.concatenate([[0], group, [len(bucket)]])
        for a, b in zip(group[:-1].tolist(), group[1:].tolist()):
            text = data[int(places[first[a]]) : int(places[first[b]])].to_pybytes()
            packed = self.pack(lengths[a:b], weights[a:b], text)
            yield int(bucket[a]), langs[lang[a]], packed, b - a


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["bucket", "lang", "suffixes", "n"])


def _bucket(hashes: list[np.ndarray], lang: np.ndarray, buckets: int) -> np.ndarray:
    out = lang.copy()
    for part in hashes:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + part)
    return (out % np.uint64(buckets)).astype(np.int64)


def _suffixes(longest: int, buckets: int):
    """Packed suffixes of (lang, text) rows."""

    def fold(packer: Packer, names, ids: np.ndarray, lang: np.ndarray, langs: list[str], lead: int, seeds):
        """Distinct suffixes with weights, to the bucket of their ``lead`` leading words."""
        size = len(names) + 1
        pair = lang * size + ids[0]
        heads = None
        for depth in range(1, len(ids)):
            _, pair = np.unique(pair, return_inverse=True)
            if depth == 2:
                heads = pair
            pair = pair * size + (ids[depth] + 1)
        _, first, weights = np.unique(pair, return_index=True, return_counts=True)
        hashes = _hashes(names)
        lead_words = [hashes[ids[i][first]] for i in range(lead)]
        bucket = _bucket(lead_words, seeds[lang[first]], buckets)
        if heads is not None:  # pairs with many suffixes in this slice
            many = np.bincount(heads[first])
            at = np.flatnonzero(many * 2 * _HOT_SHARE > len(first))
            of = dict(zip(heads[first].tolist(), first.tolist())) if len(at) else {}
            for head in at.tolist():
                two = [names[int(ids[i][of[head]])].as_py() for i in (0, 1)]
                yield _HEAVY, langs[lang[of[head]]], b"".join(two), int(many[head])
        order = np.lexsort((lang[first], bucket))
        first, weights = first[order], weights[order]
        yield from packer.rows(names, ids[:, first], weights, bucket[order], lang[first], langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer()
        for batch in batches:
            langs, codes = _numbers(pc.fill_null(batch.column(0).cast(pa.string()), _NO_LANGUAGE))
            seeds, langs = _hashes(langs), langs.to_pylist()
            for data, offsets, start in _parts(*flat(batch.column(1)), _SLICE_BYTES):
                words, rows, piece = _words(data, offsets)
                if not len(words):
                    continue
                names, ids = _numbers(words)
                lang = codes[start + rows]
                counts = np.bincount(lang, minlength=len(langs))
                out = [(_WORDS, langs[i], None, int(counts[i])) for i in np.flatnonzero(counts)]
                out += fold(packer, names, ids[None, :], lang, langs, 1, seeds)
                after = np.full((longest, len(ids)), -1)
                after[0] = ids
                for depth in range(1, longest):
                    same = piece[depth:] == piece[:-depth]
                    after[depth, :-depth][same] = ids[depth:][same]
                pairs = after[1] >= 0
                if pairs.any():
                    out += fold(packer, names, after[:, pairs], lang[pairs], langs, 2, seeds)
                yield _batch(out)
                release_memory()

    return run


def _scattered(homes: dict[int, list[tuple[str, bytes, bytes]]], buckets: int):
    """Packed rows again, the suffixes of hot pairs by their first three words, from ``buckets`` on.

    ``homes`` has the pairs by the bucket they come from. There each stays as suffixes of two words with
    all of its weight.
    """

    def split(packer: Packer, bucket: int, lang: str, packed: bytes, n: int) -> Iterator[tuple]:
        lengths, weights, words = packer.unpack(packed, n)
        names, ids = _numbers(_terminated(words))
        after = _columns(lengths, ids, max(2, int(lengths.max())))
        number = {text: i for i, text in enumerate(names.to_pylist())}
        hashes, seed, left = _hashes(names), _hashes(pa.array([lang])), np.ones(n, bool)
        for one, two in ((number.get(a), number.get(b)) for name, a, b in homes[bucket] if name == lang):
            hit = (after[0] == one) & (after[1] == two) if None not in (one, two) else ~left & left
            if not hit.any():
                continue
            left &= ~hit
            total = int(weights[hit].sum(dtype=np.int64))
            for part in range(0, total, _WEIGHT):
                weight = np.array([min(total - part, _WEIGHT)])
                yield from packer.rows(names, np.array([[one], [two]]), weight, np.array([bucket]), _ONE, [lang])
            far = np.flatnonzero(hit & (lengths > 2))
            if len(far):
                to = _bucket([hashes[after[i][far]] for i in range(3)], np.repeat(seed, len(far)), buckets)
                order = np.argsort(to, kind="stable")
                far, to, none = far[order], to[order] + buckets, np.zeros(len(to), np.int64)
                yield from packer.rows(names, after[:, far], weights[far], to, none, [lang])
        rest = np.flatnonzero(left)
        if len(rest):
            same = np.full(len(rest), bucket)
            yield from packer.rows(names, after[:, rest], weights[rest], same, np.zeros_like(same), [lang])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer()
        for batch in batches:
            for row in zip(*batch.columns):
                yield _batch(list(split(packer, *[value.as_py() for value in row])))

    return run


def _terminated(words: bytes) -> pa.Array:
    """The words of a text that has a blank after each."""
    data = np.frombuffer(words, np.uint8)
    places = np.append(0, np.flatnonzero(data == 0x20) + 1).astype(np.int64)
    buffers = [None, pa.py_buffer(places), pa.py_buffer(words)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places) - 1, buffers)


def _columns(lengths: np.ndarray, ids: np.ndarray, depth: int) -> np.ndarray:
    """Numbers of the first, second, ... word of each suffix, -1 where there is none."""
    first = np.cumsum(lengths, dtype=np.int64) - lengths
    out = np.full((depth, len(lengths)), -1)
    for i in range(depth):
        some = lengths > i
        out[i, some] = ids[first[some] + i]
    return out


def three_way(keys: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey quicksort of suffixes given by the numbers of their words, a row per depth.

    Yields (words, suffix, count): for phrases of so many words, a suffix that begins with each and
    their counts, of at least ``least``. Numbers below 0 end a suffix.
    """
    depths = len(keys)
    order = np.flatnonzero(keys[0] >= 0)
    starts, depth = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(order):
        sizes = np.diff(starts, append=len(order))
        heavy = np.add.reduceat(weights[order], starts) >= least
        if not heavy.all():  # abandon what cannot reach the least count
            order = order[np.repeat(heavy, sizes)]
            sizes, depth = sizes[heavy], depth[heavy]
            if not len(order):
                return
            starts = np.cumsum(sizes) - sizes
        at = np.repeat(depth, sizes)
        key = keys[at, order]
        pivot = np.repeat(key[starts + sizes // 2], sizes)
        side = (key > pivot).astype(np.int64) - (key < pivot) + 1
        # Stable three-way partition of all parts: places by running counts of the sides.
        new = np.empty_like(order)
        begin, parts = starts, []
        for which in range(3):
            chosen = side == which
            running = np.cumsum(chosen)
            before = running[starts] - chosen[starts]
            number = np.add.reduceat(chosen, starts, dtype=np.int64)
            new[(np.repeat(begin - before, sizes) + running - 1)[chosen]] = order[chosen]
            parts.append((begin, number))
            begin = begin + number
        order = new
        begin, number = parts[1]
        ends = begin + number
        total = np.append(0, np.cumsum(weights[order]))
        count = total[ends] - total[begin]
        frequent = count >= least
        for words in range(1, depths + 1):
            here = frequent & (depth == words - 1)
            if here.any():
                yield words, order[begin[here]], count[here]
        # Equal parts go on one word deeper, without suffixes that end there.
        deeper = frequent & (depth < depths - 1)
        firsts = np.concatenate([parts[0][0], begin, parts[2][0]])
        numbers = np.concatenate([parts[0][1], np.where(deeper, number, 0), parts[2][1]])
        next_depth = np.concatenate([depth, depth + 1, depth])
        some = np.flatnonzero(numbers)
        firsts, numbers, next_depth = firsts[some], numbers[some], next_depth[some]
        ends = np.cumsum(numbers)
        places = np.repeat(firsts - (ends - numbers), numbers) + np.arange(ends[-1] if len(ends) else 0)
        order = order[places]
        open_ = keys[np.repeat(next_depth, numbers), order] >= 0
        numbers = np.add.reduceat(open_, ends - numbers, dtype=np.int64) if len(ends) else numbers
        order, some = order[open_], numbers > 0
        numbers, depth = numbers[some], next_depth[some]
        starts = np.cumsum(numbers) - numbers


def _counted(least: int, longest: int, buckets: int):
    """Counts of phrases (lang, words, phrase, n) from packed rows in order of their bucket.

    A chunk ends with a bucket. Of a bucket that is too large for that the counts are partial, and
    all of them are kept.
    """

    def sort(packer: Packer, rows: list[tuple], least: int) -> Iterator[tuple]:
        unpacked = [packer.unpack(packed, n) for _, _, packed, n in rows]
        lengths = np.concatenate([u[0] for u in unpacked])
        weights = np.concatenate([u[1] for u in unpacked]).astype(np.int64)
        names, ids = _numbers(_terminated(b"".join(u[2] for u in unpacked)))
        sizes = [n for *_, n in rows]
        langs, lang = _numbers(pa.array([lang for _, lang, *_ in rows], pa.string()))
        lang = np.repeat(lang, sizes)
        far = np.repeat(np.array([bucket >= buckets for bucket, *_ in rows]), sizes)
        keys = _columns(lengths, ids, longest)
        langs = langs.to_pylist()
        # A word by itself is counted at the first depth, and other suffixes from the second on, where
        # hot ones that lie apart from their pair are counted at the last depths only.
        single = lengths == 1
        for chosen, counts in ((single, lambda w: w == 1), (~single & ~far, lambda w: w > 1), (far, lambda w: w > 2)):
            some = np.flatnonzero(chosen)
            if not len(some):
                continue
            sub = keys[:, some]
            sub[0] += lang[some] * len(names)  # the language is part of the first word
            # A finer route by the same words: one below the least count is abandoned as a whole.
            route = sub[0] * _SPREAD + (0 if chosen is single else sub[1])
            route = mix(route.astype(np.uint64)) & np.uint64(_ROUTES - 1)
            enough = np.bincount(route.astype(np.int64), weights[some])[route.astype(np.int64)] >= least
            sub, some = sub[:, enough], some[enough]
            for words, suffix, n in three_way(sub, weights[some], least):
                if not counts(words):
                    continue
                where = some[suffix]
                columns = [names.take(pa.array(keys[i][where])).cast(pa.large_binary()) for i in range(words)]
                phrase = columns[0]
                for column in columns[1:]:
                    phrase = pc.binary_join_element_wise(phrase, column, pa.scalar(b"", pa.large_binary()))
                for one, text, count in zip(lang[where].tolist(), phrase.to_pylist(), n.tolist()):
                    yield langs[one], words, text[:-1].decode(), count

    def table(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [[]] * 4
        kinds = [pa.string(), pa.int32(), pa.string(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "words", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, whole, part, n, cut = Packer(), [], [], 0, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = tuple(column[i].as_py() for column in batch.columns)
                last = (whole or part or [row])[-1][0]
                if n >= _CHUNK and (row[0] != last or n >= 4 * _CHUNK):
                    if row[0] == last:  # in the middle of a bucket: its counts are partial
                        cut = last
                        part += [r for r in whole if r[0] == cut]
                        whole = [r for r in whole if r[0] != cut]
                    for rows, bound in ((whole, least), (part, 1)):
                        if rows:
                            yield table(list(sort(packer, rows, bound)))
                    whole, part, n = [], [], 0
                    release_memory()
                (part if row[0] == cut else whole).append(row)
                n += row[3]
        for rows, bound in ((whole, least), (part, 1)):
            if rows:
                yield table(list(sort(packer, rows, bound)))
        release_memory()

    return run


def phrase_counts(
    docs: DataFrame, lang_column: str = "lang", text_column: str = "text",
    longest: int = LONGEST, least: int = LEAST,
) -> tuple[DataFrame, DataFrame]:
    """Phrases (``lang``, ``words``, ``phrase``, ``n``) of up to ``longest`` words that occur ``least``
    times or more in the texts of a language, and all words of each (``lang``, ``n``)."""
    texts = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, size // _BUCKET_BYTES)
    packed = written(texts.mapInArrow(_suffixes(longest, buckets), _PACKED), "suffixes")
    totals = packed.filter(F.col("bucket") == _WORDS).groupBy("lang").agg(F.sum("n").alias("n"))
    suffixes = packed.filter("bucket >= 0")
    hot = _hot_pairs(packed)
    if hot:
        homes = _homes(hot, buckets)
        at_home = F.col("bucket").isin(*homes)
        moved = suffixes.filter(at_home).mapInArrow(_scattered(homes, buckets), _PACKED)
        suffixes = suffixes.filter(~at_home).unionByName(moved)
    counts = (
        suffixes.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_counted(least, longest, buckets), "lang string, words int, phrase string, n bigint")
        .groupBy("lang", "words", "phrase")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
    )
    return written(counts, "phrases"), totals


def _hot_pairs(packed: DataFrame) -> set[tuple[str, bytes]]:
    """Pairs with over 1/500 of all suffixes, and no more than a thousand.

    One with such a share has half of it in slices where it has half of that share or more, and
    these name it.
    """
    total = packed.filter("bucket >= 0").agg(F.sum("n")).first()[0] or 0
    heavy = packed.filter(F.col("bucket") == _HEAVY).groupBy("lang", "suffixes").agg(F.sum("n").alias("n"))
    rows = heavy.filter(F.col("n") * 2 * _HOT_SHARE > total).select("lang", "suffixes").collect()
    return {(row[0], bytes(row[1])) for row in rows}


def _homes(hot: set[tuple[str, bytes]], buckets: int) -> dict[int, list[tuple[str, bytes, bytes]]]:
    """Hot pairs by the bucket they are routed to."""
    out: dict[int, list[tuple[str, bytes, bytes]]] = {}
    for lang, pair in sorted(hot):
        one, two = (word + b" " for word in pair.split(b" ")[:2])
        seeds = _hashes(pa.array([lang]))
        home = _bucket([_hashes(pa.array([one])), _hashes(pa.array([two]))], seeds, buckets)
        out.setdefault(int(home[0]), []).append((lang, one, two))
    return out


def _cuts(counts: DataFrame, longest: int) -> Column:
    """All ways to cut a phrase in two, as (words of the first part, first part, rest)."""
    parts = F.split("phrase", " ")

    def cut(k: int) -> Column:
        rest = F.slice(parts, F.lit(k + 1), F.size(parts) - k)
        return F.struct(
            F.lit(k).alias("k"),
            F.array_join(F.slice(parts, 1, k), " ").alias("left"),
            F.array_join(rest, " ").alias("right"),
        )

    return F.filter(F.array(*[F.when(F.col("words") > k, cut(k)) for k in range(1, longest)]), lambda c: c.isNotNull())


def collocations(
    docs: DataFrame, lang_column: str = "lang", text_column: str = "text",
    longest: int = LONGEST, least: int = LEAST, percent: int = PERCENT, top: int = TOP, scale: int = SCALE,
) -> DataFrame:
    """The ``top`` phrases per language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are in lower case (A-Z), pieces end at ``.,;:!?`` and line breaks, words at blanks and tabs. A
    phrase has 2 to ``longest`` words and occurs ``a`` times, ``least`` or more; ``n`` are all words of
    the language. Its score is ``floor(scale a a / (l r))`` for the counts of its two parts, at the cut
    with the lowest, the first of these. Phrases within a longer one that has ``percent`` of
    their count or more are left out. Ranks go by score, then count, both from the largest, then phrase.
    NULL is the language ``und`` and an empty text. Rows that repeat count again; any other
    columns are not looked at; without a word there are no rows.
    """
    counts, totals = phrase_counts(docs, lang_column, text_column, longest, least)
    phrases = counts.filter("words > 1").withColumnRenamed("n", "a")
    of = counts.select("lang", "phrase", "n")
    cuts = phrases.select("lang", "words", "phrase", "a", F.inline(_cuts(phrases, longest)))
    cuts = cuts.join(of.toDF("lang", "left", "l"), ["lang", "left"]).join(of.toDF("lang", "right", "r"), ["lang", "right"])
    whole = lambda name: F.col(name).cast("decimal(19,0)")
    above = (F.lit(scale).cast("decimal(7,0)") * whole("a") * whole("a")).cast("decimal(38,0)")
    cuts = cuts.withColumn("above", above).withColumn("below", (whole("l") * whole("r")).cast("decimal(38,0)"))
    score = F.expr("above div below").alias("score")
    scored = cuts.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct(score, "k", "l", "r")).alias("cut"))
    # Phrases within longer ones, with the largest count of these.
    within = phrases.filter("words > 2").select(
        "lang", F.explode(_inner(longest)).alias("phrase"), F.col("a").alias("longer")
    )
    within = within.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(within, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))
    )
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # The first of each part of a language, then of these: no task sorts all phrases of a hot language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))).orderBy(*order)
    first = Window.partitionBy("lang").orderBy(*order)
    kept = kept.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _inner(longest: int) -> Column:
    """Contiguous phrases of two words or more within a longer one."""
    parts = F.split("phrase", " ")
    inner = [
        F.when(F.col("words") >= start + size, F.array_join(F.slice(parts, start + 1, size), " "))
        for size in range(2, longest)
        for start in range(longest - size + 1)
    ]
    all_inner = F.filter(F.array(*inner), lambda p: p.isNotNull() & (p != F.col("phrase")))
    return F.array_distinct(all_inner)


def op12_three_way_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))
