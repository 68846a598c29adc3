"""Removal of byte strings that occur twice, by merging shard Burrows-Wheeler transforms.

Finding what could repeat. Every 200-byte string of a document belongs to the smallest hash among its 64-byte grams,
so equal strings belong to equal hashes. Neighbouring strings of one hash form a segment, which is named by 128 bits
of its bytes. Only segments whose hash is found again can hold a repeat; the others are left out. A name's bytes are
looked up once, in one of the documents that have it, and stand for all its copies by weight.

Finding what does repeat. Segments of one hash meet in a task and are put into shards. A shard's suffixes are sorted,
which gives its Burrows-Wheeler transform, in symbols of 16 bytes, and the map from each suffix to the one that
starts a symbol earlier. The transforms are merged by interleave refinement: from the interleaving of all suffixes
by their first h bytes, walking it and dropping each preceding symbol into its bucket gives that by the first h + 16
bytes, and where symbol or interval changes, a common prefix ends. A suffix alone in its interval has its longest
common prefix with the neighbours found and is left behind, with the suffixes before it. Suffixes with a common
prefix of 200 bytes are the repeated strings.

Hot groups. Where the different segments of one hash are more than a task should hold, they are cut again by the
smallest hash among their longer grams, 128 and 192 bytes and last of all the 200-byte string itself, whose group is
a single string. So every group is merged in bounded memory, and by the same method.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgap.llm import hotkeys, wordhash
from reelgap.llm.scratch import Scratch, release_shuffles

LENGTH, GRAM = 200, 64
#: Bytes that are read as one number, and bytes of a symbol of the transform.
WORD, SYMBOL = 8, 16
#: Bytes of segments that are merged together, bytes of a shard, and bytes of one hash's different segments that aren't cut again.
BATCH, SHARD, MOST = 1 << 20, 1 << 16, 1 << 20


def _sums(letters: np.ndarray) -> np.ndarray:
    up, _ = wordhash._powers(len(letters) + 1)
    sums = np.empty(len(letters) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(letters * up[: len(letters)], out=sums[1:])
    return sums


def _words(data: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes at each of the first ``n`` places as one number, in the bytes' order."""
    return np.ndarray((n,), ">u8", data.data, strides=(1,)).astype(np.uint64)


def segments(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, level: int = 0) -> tuple[np.ndarray, ...]:
    """(text, first string, strings, hash, occurrences, name) of each segment.

    ``occurrences`` is 2 where the hash's gram comes twice inside the segment, which so may repeat within itself. With
    grams as long as the strings, each string is a segment. Another ``level`` has other hashes.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.view(np.uint64), none, none.view(np.uint64)
    _, down = wordhash._powers(len(data) + 1)
    sums = _sums(wordhash.LETTERS[data])
    grams = wordhash.mix((sums[gram:] - sums[:-gram]) * down[: len(sums) - gram] + np.uint64(level))
    width = length - gram + 1
    least, span = grams, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[: len(grams) - width + 1], least[width - span : len(grams) - span + 1])
    # strings inside one text only
    whole = np.flatnonzero(sizes >= length)
    begin, end = starts[whole], starts[whole] + sizes[whole] - length
    new = np.empty(len(least), bool)
    new[0] = True
    np.not_equal(least[1:], least[:-1], out=new[1:])
    if gram == length:
        new[:] = True
    new[begin] = True
    stop = np.zeros(len(least) + 1, bool)
    stop[end + 1] = True
    inside = np.zeros(len(least) + 1, np.int8)
    np.add.at(inside, begin, 1)
    np.add.at(inside, end + 1, -1)
    inside = np.cumsum(inside[:-1]).astype(bool)
    first = np.flatnonzero(new & inside)
    edge = np.flatnonzero(np.concatenate((new, [True])) | stop)
    last = edge[np.searchsorted(edge, first, side="right")]
    text = whole[np.searchsorted(begin, first, side="right") - 1]
    hashes = least[first]
    twice = np.ones(len(first), np.int64)
    many = last - first > width  # a gram is in at most ``width`` strings
    twice[many] = 2
    for low in range(0, len(first) if width > 1 else 0, 4096):
        part = np.arange(low, min(low + 4096, len(first)))
        part = part[~many[part]]
        spot = first[part, None] + np.arange(2 * width - 1)[None, :]
        hit = (grams[np.minimum(spot, len(grams) - 1)] == hashes[part, None]) & (spot < (last[part] + width - 1)[:, None])
        twice[part[hit.sum(1) > 1]] = 2
    del grams, least, sums
    # a polynomial over mixed eight-byte symbols, unlike that of the grams over single bytes
    sums = _sums(wordhash.mix(_words(data, len(data) - WORD + 1)))
    name = wordhash.mix((sums[last + length - WORD] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return text, first - starts[text], last - first, hashes, twice, name


class Shard:
    """Strings side by side with their sorted suffixes, the symbol before each suffix, and where that one starts."""

    def __init__(self, strings: list[bytes], weights: list[int], length: int) -> None:
        self.data = np.frombuffer(b"".join(strings) + bytes(WORD), np.uint8)
        sizes = np.array([len(s) for s in strings], np.int64)
        n = int(sizes.sum())
        starts = np.cumsum(sizes) - sizes
        self.string = np.repeat(np.arange(len(strings)), sizes)
        self.left = np.repeat(starts + sizes, sizes) - np.arange(n)  # bytes to the end of the string
        self.offset = np.arange(n) - starts[self.string]
        self.weight = np.asarray(weights, np.int64)[self.string]
        #: Eight bytes at each place. The transform is, in sorted order, the symbol before each suffix, with the rank of the suffix it starts (-1: none).
        self.words = _words(self.data, n)
        self.order = _sorted_suffixes(self.words, length)
        rank = np.empty(n, np.int64)
        rank[self.order] = np.arange(n)
        before = self.order - SYMBOL
        has = self.offset[self.order] >= SYMBOL
        self.earlier = np.where(has, rank[np.where(has, before, 0)], -1) if n else np.zeros(0, np.int64)


def _sorted_suffixes(words: np.ndarray, length: int) -> np.ndarray:
    """Places by their next ``length`` bytes or more, by prefix doubling from eight bytes on; those alike go on."""
    order = np.argsort(words, kind="stable")
    n, width = len(order), WORD
    if not n:
        return order
    head = np.concatenate(([True], words[order[1:]] != words[order[:-1]]))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    while width < length:
        tied = np.flatnonzero(~head | ~np.concatenate((head[1:], [True])))
        if not len(tied):
            break
        places = order[tied]
        key = rank[places] << 32 | rank[np.minimum(places + width, n)] + 1
        by = np.argsort(key, kind="stable")
        order[tied], key = places[by], key[by]
        head[tied] = np.concatenate(([True], key[1:] != key[:-1]))
        rank[order[tied]] = np.maximum.accumulate(np.where(head[tied], tied, 0))
        width *= 2
    return order


def merged_prefixes(shards: list[Shard], length: int = LENGTH) -> list[np.ndarray]:
    """For each shard, the common prefix in bytes that each suffix, in sorted order, has with another suffix of any shard.

    It is counted in whole symbols from ``length`` down; ``length`` itself means that or more. A suffix alone in its
    interval has no other to share a longer prefix with, nor have the suffixes before it, so it is left behind.
    """
    offsets = np.cumsum([0] + [len(s.order) for s in shards])
    start = length % SYMBOL or SYMBOL
    words = np.concatenate([s.words for s in shards])
    dense, first = (np.split(_dense(words, m), offsets[1:-1]) for m in (SYMBOL, start))
    first = np.concatenate([d[s.order] for s, d in zip(shards, first, strict=True)])
    symbols = np.concatenate([d[np.maximum(s.order - SYMBOL, 0)] for s, d in zip(shards, dense, strict=True)])
    earlier = np.concatenate([np.where(s.earlier >= 0, s.earlier + o, -1) for s, o in zip(shards, offsets[:-1], strict=True)]).astype(np.int32)
    left = np.concatenate([s.left[s.order] for s in shards])
    common = np.zeros(offsets[-1], np.int32)
    # the suffixes in buckets of their first symbol
    suffix = np.flatnonzero(left >= start).astype(np.int32)
    suffix, interval = _place(suffix, first[suffix], np.zeros(len(suffix), np.int32))
    common[suffix] = start
    for depth in range(start + SYMBOL, length + 1, SYMBOL):
        before = earlier[suffix]
        has = before >= 0
        suffix, interval = _place(before[has], symbols[suffix[has]], interval[has])
        common[suffix] = depth
    return np.split(common, offsets[1:-1])


def _dense(words: np.ndarray, m: int) -> np.ndarray:
    """The ``m`` bytes at each place, 1 to 16, as small numbers in the bytes' order; places near the end have any number."""
    if m <= WORD:
        return np.unique(words >> np.uint64(8 * (WORD - m)), return_inverse=True)[1].astype(np.int32)
    dense = np.unique(words, return_inverse=True)[1]
    ahead = np.concatenate((dense[m - WORD :], dense[: m - WORD]))[: len(dense)]
    return np.unique(dense << 32 | ahead, return_inverse=True)[1].astype(np.int32)


def _place(suffix: np.ndarray, symbols: np.ndarray, interval: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes dropped into the buckets of their symbols in the order given; intervals of one are left out."""
    if not len(suffix):
        return suffix, interval
    dropped = symbols.astype(np.int64) << 32 | np.arange(len(suffix))  # bucket, then place in the walk
    dropped.sort()
    order, symbols = (dropped & 0xFFFFFFFF).astype(np.int32), dropped >> 32
    interval = interval[order]
    new = np.ones(len(suffix) + 1, bool)
    np.not_equal(symbols[1:], symbols[:-1], out=new[1:-1])
    new[1:-1] |= interval[1:] != interval[:-1]
    keep = np.flatnonzero(~(new[:-1] & new[1:]))
    return suffix[order[keep]], np.cumsum(new[:-1], dtype=np.int32)[keep]


def repeated(strings: list[bytes], weights: list[int], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each string, the ranges [from, to) of places where a repeated ``length``-byte string starts.

    It stands for all its copies by weight: where there are two, each of its strings is repeated.
    """
    shards, members, held, n = [], [], [], 0
    for i, s in enumerate(strings):
        held.append(i)
        n += len(s)
        if n >= SHARD or i == len(strings) - 1:
            shards.append(Shard([strings[j] for j in held], [weights[j] for j in held], length))
            members.append(held)
            held, n = [], 0
    out: list[list[tuple[int, int]]] = [[] for _ in strings]
    for shard, own, common in zip(shards, members, merged_prefixes(shards, length) if shards else (), strict=True):
        found = (shard.weight > 1) & (shard.left >= length)
        found[shard.order[common >= length]] = True
        if len(places := np.flatnonzero(found)):
            string, offset = shard.string[places], shard.offset[places]
            cut = np.flatnonzero(np.concatenate(([True], (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1))))
            for a, b in zip(cut.tolist(), [*(cut[1:] - 1).tolist(), len(places) - 1], strict=True):
                out[own[string[a]]].append((int(offset[a]), int(offset[b]) + 1))
    return out


def _columns(rows: list[tuple], kinds: list, names: list[str]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def pieces(data: bytes, length: int, size: int = wordhash.CHUNK) -> Iterator[tuple[int, bytes]]:
    """(first place, bytes) of pieces that have each string of ``data`` once; a segment that lies in two is two segments."""
    for at in range(0, max(len(data) - length + 1, 1), size):
        yield at, data[at : at + size + length - 1]


FOUND = ("id", "weight", "at", "span", "hash", "twice", "name")


def _found(strings: DataFrame, length: int, gram: int, level: int) -> DataFrame:
    """A row of FOUND for every segment of ``strings`` (id, weight, data)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), (d.as_py() for d in batch.column(2)), strict=True)
            for chunk in wordhash.chunks((i, w, base, part) for i, w, d in rows for base, part in pieces(d, length)):
                text, at, n, hashes, twice, names = segments([d for *_, d in chunk], length, gram, level)
                ids, weights, bases = (np.array([c[i] for c in chunk], np.int64)[text] for i in (0, 1, 2))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, weights, bases + at, n, hashes.view(np.int64), twice, names.view(np.int64))], names=list(FOUND))

    return strings.select("id", "weight", "data").mapInArrow(run, ", ".join(f"{c} long" for c in FOUND))


def _contents(strings: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(hash, name, weight, content) of ``wanted`` (id, at, span, hash, name, weight), from the strings that have them."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds, names = [pa.int64()] * 3 + [pa.binary()], ["hash", "name", "weight", "content"]
        for batch in batches:
            out, size = [], 0
            for data, own in zip(batch.column(0), batch.column(1), strict=True):
                data = data.as_py()
                for s in own.as_py():
                    out.append((s["hash"], s["name"], s["weight"], data[s["at"] : s["at"] + s["span"] + length - 1]))
                    size += len(out[-1][3])
                if size >= wordhash.CHUNK:
                    yield _columns(out, kinds, names)
                    out, size = [], 0
            yield _columns(out, kinds, names)

    own = wanted.groupBy("id").agg(F.collect_list(F.struct("at", "span", "hash", "name", "weight")).alias("own"))
    return strings.select("id", "data").join(own, "id").select("data", "own").mapInArrow(run, "hash long, name long, weight long, content binary")


def _merge(batches: Iterator, length: int, batch_bytes: int) -> Iterator:
    """(hash, name, n, ranges) from (hash, name, weight, content) sorted by hash: ``n`` is the weight, ``ranges`` has the places in the segment where a repeated string starts."""
    import pyarrow as pa

    place = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
    kinds, names = [pa.int64()] * 3 + [place], ["hash", "name", "n", "ranges"]
    ready: list[tuple] = []
    size, last = 0, None

    def flush():
        found = zip(ready, repeated([r[3] for r in ready], [r[2] for r in ready], length), strict=True)
        out = [(h, name, weight, [{"low": a, "high": b} for a, b in ranges]) for (h, name, weight, _), ranges in found if ranges]
        ready.clear()
        return _columns(out, kinds, names)

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if size >= batch_bytes and row[0] != last:
                yield flush()
                size = 0
            ready.append(row)
            size, last = size + len(row[3]), row[0]
    yield flush()


def repeats(strings: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM, batch_bytes: int = BATCH, most: int = MOST, level: int = 0) -> DataFrame:
    """(id, low, high): places [low, high) of ``strings`` (id, weight, data) where a repeated string starts."""
    spark, name = strings.sparkSession, lambda x: f"{x}{level}"
    width = min((level + 1) * gram, length) if (level + 1) * gram < length and level < 3 else length
    found = scratch.keep(_found(strings, length, width, level), name("segments"))
    again = scratch.keep(found.groupBy("hash").agg(F.sum(F.col("weight") * F.col("twice")).alias("n")).where("n > 1"), name("again"))
    total = again.agg(F.sum("n")).first()[0] or 0
    live = scratch.keep(hotkeys.joined(found, again, ["hash"], total).drop("n"), name("live"))
    scratch.drop(name("segments"), name("again"))
    release_shuffles(spark)
    one = live.groupBy("hash", "name").agg(F.sum("weight").alias("weight"), F.max("span").alias("span"), F.min(F.struct("id", "at")).alias("one"))
    one = scratch.keep(one.select("hash", "name", "weight", "span", "one.id", "one.at"), name("one"))
    groups = one.groupBy("hash").agg(F.sum(F.col("span") + length - 1).alias("bytes"), F.count(F.lit(1)).alias("many"))
    large = scratch.keep(groups.where((F.col("bytes") > most) & F.lit(width < length)).select("hash", F.col("many").alias("n")), name("large"))
    hot = not large.isEmpty()
    contents = _contents(strings, one, length)
    if hot:  # the bytes are looked up once, for both kinds of groups
        contents = scratch.keep(contents.select(F.monotonically_increasing_id().alias("id"), "hash", "name", "weight", F.col("content").alias("data")), name("contents"))
        release_shuffles(spark)
        total_large = large.agg(F.sum("n")).first()[0]
        cut = scratch.keep(hotkeys.joined(contents, large, ["hash"], total_large).drop("n"), name("cut"))
        contents = contents.select("hash", "name", "weight", F.col("data").alias("content")).join(large.select("hash"), "hash", "left_anti")
    contents = contents.repartition("hash").sortWithinPartitions("hash", "name")
    flagged = scratch.keep(contents.mapInArrow(lambda b: _merge(b, length, batch_bytes), "hash long, name long, n long, ranges array<struct<low: long, high: long>>"), name("flagged"))
    scratch.drop(name("contents"))
    release_shuffles(spark)
    if hot:  # the different segments of a large group are strings to be cut by longer grams
        deeper = repeats(cut, scratch, length, gram, batch_bytes, most, level + 1).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("ranges"))
        deeper = deeper.select("id", _joined_ranges(F.col("ranges")).alias("ranges"))
        flagged = flagged.unionByName(cut.select("id", "hash", "name", F.col("weight").alias("n")).join(deeper, "id").drop("id"))
    at = hotkeys.joined(live.select("hash", "name", "id", "at"), flagged, ["hash", "name"], total)
    at = at.select("id", "at", F.explode("ranges").alias("r"))
    return scratch.keep(at.select("id", (F.col("at") + F.col("r.low")).alias("low"), (F.col("at") + F.col("r.high")).alias("high")), name("places"))


def _joined_ranges(ranges: Column) -> Column:
    """Sorted ranges (low, high) with those that touch made one; a segment has few places, so the array is short."""
    none = F.slice(ranges, 1, 0)
    last = lambda a: F.element_at(a, -1)
    grown = lambda a, r: F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(last(a)["low"].alias("low"), F.greatest(last(a)["high"], r["high"]).alias("high"))))
    return F.aggregate(ranges, none, lambda a, r: F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["high"] >= r["low"]), grown(a, r)).otherwise(F.concat(a, F.array(r))))


def _spans(docs: DataFrame, scratch: Scratch, length: int, **sizes: int) -> tuple[DataFrame, DataFrame]:
    """(rows, ranges): ``docs`` with a number for each row (_id) and its text's bytes (_data), and for each number the sorted places where a repeated string starts.

    The numbers are written with the rows, so a lost executor doesn't change them.
    """
    rows = scratch.keep(docs.select(F.monotonically_increasing_id().alias("_id"), F.struct("*").alias("_row")), "rows")
    rows = rows.withColumn("_data", F.coalesce(F.col("_row.text").cast("string"), F.lit("")).cast("binary"))
    strings = rows.where(F.octet_length("_data") >= length).select(F.col("_id").alias("id"), F.lit(1).cast("long").alias("weight"), F.col("_data").alias("data"))
    places = repeats(strings, scratch, length, **sizes)
    ranges = places.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("low", "high"))).alias("_ranges")).withColumnRenamed("id", "_id")
    ranges = scratch.keep(ranges, "ranges")
    scratch.drop(*[f"{t}{k}" for t in ("live", "one", "large", "flagged", "cut", "places") for k in range(5)])
    release_shuffles(docs.sparkSession)
    return rows, ranges


def removed_spans(ranges: list[dict], length: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes that repeated strings starting in ``ranges`` cover."""
    out: list[tuple[int, int]] = []
    for r in ranges:
        low, high = r["low"], r["high"] - 1 + length
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in spans)]
    return b"".join(data[a:b] for a, b in zip(ends, [*(a for a, _ in spans), len(data)], strict=True))


def digests(docs: DataFrame, length: int = LENGTH, **sizes: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of ``docs`` (doc_id, text).

    Every byte goes that lies in a ``length``-byte string which also starts elsewhere, in the same row or another;
    overlaps count, and strings are judged on the input. A null text is empty; texts under ``length`` bytes keep all; a
    text of any length is cut into segments as a whole; a row that repeats another one loses all its bytes like it; a
    null doc_id stays null; an empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "suffix_dedup")
    rows, ranges = _spans(docs.select("doc_id", "text"), scratch, length, **sizes)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for i, data, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                spans = removed_spans(own.as_py(), length)
                out.append((i, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept_bytes(data.as_py(), spans)).hexdigest()))
            yield _columns(out, [pa.int64(), pa.int64(), pa.int64(), pa.string()], ["_id", "n_removed", "n_spans", "sha"])

    cut = rows.select("_id", "_data").join(ranges, "_id").select("_id", "_data", "_ranges").mapInArrow(run, "_id long, n_removed long, n_spans long, sha string")
    every = rows.select("_id", F.col("_row.doc_id").cast("long").alias("doc_id"), F.octet_length("_data").cast("long").alias("n_bytes"), F.sha2("_data", 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return every.join(cut, "_id", "left").select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"))


def keep_unrepeated(docs: DataFrame, length: int = LENGTH, **sizes: int) -> DataFrame:
    """``docs`` with the bytes that ``digests`` removes cut out of ``text`` (and ``n_chars``, if there, counted anew).

    A character that loses some of its bytes loses all. A row left without words goes; all other rows and columns
    stay, nulls, empty and repeated ones included.
    """
    scratch = Scratch(docs.sparkSession, "suffix_dedup")
    rows, ranges = _spans(docs, scratch, length, **sizes)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            now = []
            for data, own in zip(batch.column("_data"), batch.column("_ranges"), strict=True):
                own = own.as_py()
                now.append(None if own is None else kept_bytes(data.as_py(), removed_spans(own, length)).decode(errors="ignore"))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(now, pa.string())], names=["_row", "_now"])

    rows = rows.join(ranges, "_id", "left").select("_row", F.when(F.col("_ranges").isNotNull(), F.col("_data")).alias("_data"), "_ranges")
    row = rows.schema["_row"].dataType
    rows = rows.mapInArrow(run, T.StructType([T.StructField("_row", row), T.StructField("_now", T.StringType())]))
    rows = rows.where(F.col("_now").isNull() | F.col("_now").rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.coalesce("_now", "_row.text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_now").isNull(), F.col("_row")["n_chars"]).otherwise(F.length("_now").cast("long"))
    return rows.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
