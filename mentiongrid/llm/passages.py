r"""Removal of repeated passages: every byte covered by a string of `LENGTH` bytes that also starts in a
document with a smaller doc_id.

1. Texts are grouped by themselves; of equal texts the smallest doc_id stands for all, the others lose
   every byte if they are long enough.
2. Anchors: in each window of LENGTH bytes the `GRAM`-byte strings of least hash are anchors. Equal windows
   have equal anchors at equal places, so whatever repeats shares an anchor.
3. Anchors that occur in one document only are dropped: batches of documents send their distinct anchor hashes,
   packed by bucket, and a bitmap of those that recur goes back (of bounded size; if it fills up it drops less).
4. Every recurring anchor sends its surroundings, all windows it is the anchor of, to the task of its hash.
   There windows are compared by hash first. What repeats is cut out of the distinct surroundings, and the suffix
   array of these strings (`suffixes`, by linear grouping) gives each window the least document that has it.
5. Anchors that more than `hot` documents share would gather in one task; their windows are rows instead, whose
   least document is found by a group-by with partial aggregation.
6. Windows with a smaller document are removed from the texts, overlaps united.

Defined results: a null text is empty. A null doc_id counts as larger than all ids and equal to other nulls. Rows that
repeat a doc_id never remove each other's passages. Texts shorter than LENGTH bytes stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.llm.common import annotate, table
from mentiongrid.llm.suffixes import least_owner
from mentiongrid.session import materialise

LENGTH, GRAM = 50, 24
_REACH = LENGTH - GRAM  # how far a window reaches beyond its anchor
_STARTS = _REACH + 1
_WIDE = LENGTH + _REACH
_LAST = np.iinfo(np.int64).max
_ROWS = 40_000
HOT = 100_000


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = (left * np.uint64(0x9E3779B97F4A7C15) ^ right) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hashes(data: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Hashes of all strings along the last axis; `lengths` are falling powers of two that sum up to their length."""
    level = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    levels, size = {1: level}, 1
    while size < lengths[0]:
        level = _mix(level[..., :-size], level[..., size:])
        size *= 2
        levels[size] = level
    n = data.shape[-1] - sum(lengths) + 1
    done, at = levels[lengths[0]][..., :n], lengths[0]
    for size in lengths[1:]:
        done, at = _mix(done, levels[size][..., at : at + n]), at + size
    return done


def _extreme(x: np.ndarray, width: int, best) -> np.ndarray:
    """The least or greatest of every `width` neighbours."""
    size = 1
    while 2 * size <= width:
        x = best(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return best(x[:-rest], x[rest:]) if rest else x


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and 48-bit hashes of the anchors of a text, and whether each is the anchor of the windows at
    its place - _REACH .. its place, one column for each."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros((0, _STARTS), bool)
    grams = _hashes(np.frombuffer(data, np.uint8), [16, 8])
    least = _extreme(grams, _STARTS, np.minimum)
    edge = np.zeros(_REACH, np.uint64)
    chosen = _extreme(np.concatenate([edge, least, edge]), _STARTS, np.maximum) == grams
    places = np.flatnonzero(chosen)
    around = np.lib.stride_tricks.sliding_window_view(np.concatenate([edge, least, edge]), _STARTS)
    return places, grams[places] >> np.uint64(16), around[places] == grams[places][:, None]


def _packed(hashes: np.ndarray) -> bytes:
    """Ascending 48-bit numbers as differences, low bytes first: the high bytes are nearly all zero."""
    steps = np.diff(hashes, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(6, -1).T
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def _recurring(texts: DataFrame, buckets: int) -> DataFrame:
    """(hash, n): anchors that at least two rows have, and how many."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(anchors(t.as_py().encode("utf-8", "surrogatepass"))[1]) for t in batch.column(0)]
            hashes, counts = np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]), return_counts=True)
            place = hashes % np.uint64(buckets)
            order = np.argsort(place, kind="stable")
            hashes, counts, place = hashes[order], counts[order].astype(np.uint32), place[order]
            keys, first = np.unique(place, return_index=True)
            ends = [*first[1:], len(place)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.astype(np.int64)),
                    pa.array([_packed(hashes[a:b]) for a, b in zip(first, ends, strict=True)], pa.binary()),
                    pa.array([counts[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
                ],
                ["bucket", "hashes", "counts"],
            )

    def unite(group: pa.Table) -> pa.Table:
        hashes = np.concatenate([_unpacked(x) for x in group.column(1).to_pylist()])
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in group.column(2).to_pylist()]).astype(np.int64)
        order = np.argsort(hashes)
        hashes = hashes[order]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        total = np.add.reduceat(counts[order], first)
        many = total > 1
        return pa.table({"hash": hashes[first][many].view(np.int64), "n": total[many]})

    sent = texts.select("text").mapInArrow(send, "bucket long, hashes binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(unite, "hash long, n long")


def _places(hashes: np.ndarray, log_bits: int) -> list[np.ndarray]:
    """Two flags of each hash."""
    spread = (np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25))
    return [((hashes * factor) >> np.uint64(64 - log_bits)).astype(np.int64) for factor in spread]


def _bitmap(hashes: DataFrame, log_bits: int) -> np.ndarray:
    """A packed bitmap of 2^log_bits flags; it comes to the driver in words of 32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(_places(batch.column(0).to_numpy().view(np.uint64), log_bits))
            yield pa.RecordBatch.from_arrays([pa.array(place >> 5), pa.array(np.int64(1) << (place & 31))], ["word", "flags"])

    words = hashes.select("hash").mapInArrow(run, "word long, flags long").groupBy("word").agg(F.bit_or("flags").alias("flags")).toArrow()
    bits = np.zeros(1 << (log_bits - 5), np.uint32)
    bits[words.column("word").to_numpy()] = words.column("flags").to_numpy().astype(np.uint32)
    return bits


def _flagged(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    first, second = _places(hashes, len(bits).bit_length() + 4)
    both = (bits[first >> 5] >> (first & 31).astype(np.uint32)) & (bits[second >> 5] >> (second & 31).astype(np.uint32))
    return both & np.uint32(1) == 1


def _log_bits(n: int, most: int = 28) -> int:
    return min(most, max(10, int(16 * n).bit_length()))


def _surroundings(texts: DataFrame, bits: np.ndarray, hot: np.ndarray | None) -> DataFrame:
    """(hash, row_id, owner, place, before, around) of recurring anchors that are not hot."""
    shared = texts.sparkSession.sparkContext.broadcast((bits, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot = shared.value
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for i in range(batch.num_rows):
                data = batch.column(2)[i].as_py().encode("utf-8", "surrogatepass")
                places, hashes, own = anchors(data)
                wanted = _flagged(bits, hashes)
                if hot is not None:
                    wanted &= ~_flagged(hot, hashes)
                places, hashes, own = places[wanted], hashes[wanted].view(np.int64), own[wanted]
                first = places - _REACH + own.argmax(1)
                end = places - own[:, ::-1].argmax(1) + LENGTH
                columns[0].append(hashes)
                columns[1].append(np.full(len(places), batch.column(0)[i].as_py()))
                columns[2].append(np.full(len(places), batch.column(1)[i].as_py()))
                columns[3].append(places.astype(np.int32))
                columns[4].append((places - first).astype(np.int32))
                columns[5] += [data[a:b] for a, b in zip(first.tolist(), end.tolist(), strict=True)]
                if len(columns[5]) > 50_000:
                    yield _batch(columns)
                    columns = [[], [], [], [], [], []]
            if columns[0]:
                yield _batch(columns)

    return texts.select("row_id", "owner", "text").mapInArrow(run, "hash long, row_id long, owner long, place int, before int, around binary")


def _batch(columns: list[list]) -> pa.RecordBatch:
    kinds = [np.int64, np.int64, np.int64, np.int32, np.int32]
    arrays = [pa.array(np.concatenate(c).astype(k)) for c, k in zip(columns[:5], kinds, strict=True)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[5], pa.binary())], ["hash", "row_id", "owner", "place", "before", "around"])


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and end of every run of true values in the rows of a matrix."""
    edge = np.zeros((len(mask), 1), np.int8)
    change = np.diff(np.concatenate([edge, mask.astype(np.int8), edge], 1), axis=1)
    row, first = np.nonzero(change == 1)
    return row, first, np.nonzero(change == -1)[1]


def _compare(hashes, owners, places, before, around) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index, start and end of the repeated stretches around the anchors; all rows of a hash must be given."""
    known: dict[tuple, int] = {}
    which = np.array([known.setdefault(key, len(known)) for key in zip(hashes.tolist(), before.tolist(), around, strict=True)])
    n = len(known)
    anchor = np.array([k[0] for k in known], np.int64)
    lead = np.array([_REACH - k[1] for k in known])
    strings = [k[2] for k in known]
    least, most = np.full(n, _LAST), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(least, which, owners)
    np.maximum.at(most, which, owners)
    # All surroundings as rows of a matrix, with the anchors below each other.
    sizes = np.array([len(s) for s in strings])
    matrix = np.zeros((n, _WIDE), np.uint8)
    row = np.repeat(np.arange(n), sizes)
    matrix[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes - lead, sizes)] = np.frombuffer(b"".join(strings), np.uint8)
    first = np.arange(_STARTS)
    valid = (first >= lead[:, None]) & (first + LENGTH <= (lead + sizes)[:, None])
    part = 4096  # bounds what the hashes of all lengths occupy
    windows = np.concatenate([
        _mix(_hashes(matrix[k : k + part], [32, 16, 2]), anchor[k : k + part].view(np.uint64)[:, None])[valid[k : k + part]] for k in range(0, n, part)
    ])
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    shared = np.zeros_like(valid)
    shared[valid] = counts[inverse] > 1
    shared |= valid & (most > least)[:, None]

    owner = np.full((n, _STARTS), _LAST)
    context, start, stop = _runs(shared)
    by_anchor: dict[int, dict[bytes, list[int]]] = {}
    for k, (c, a, b) in enumerate(zip(context.tolist(), start.tolist(), stop.tolist(), strict=True)):
        cut = strings[c][a - lead[c] : b - 1 + LENGTH - lead[c]]
        by_anchor.setdefault(int(anchor[c]), {}).setdefault(cut, []).append(k)
    for cuts in by_anchor.values():
        owners_of = [int(min(least[context[k]] for k in ks)) for ks in cuts.values()]
        found = least_owner(list(cuts), owners_of, LENGTH) if len(cuts) > 1 else [owners_of * (len(next(iter(cuts))) - LENGTH + 1)]
        for ks, values in zip(cuts.values(), found, strict=True):
            for k in ks:
                owner[context[k], start[k] : stop[k]] = values
    index, a, b = _runs(owner[which] < owners[:, None])
    return index, places[index] - _REACH + a, places[index] - _REACH + b - 1 + LENGTH


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by hash; complete hashes are compared some ten thousand rows at a time."""
    held: list[pa.RecordBatch] = []

    def compare(rows: pa.Table) -> pa.RecordBatch:
        h, row, owner, place, before = (rows.column(i).to_numpy() for i in range(5))
        index, start, end = _compare(h, owner, place.astype(np.int64), before, rows.column(5).to_pylist())
        return pa.RecordBatch.from_arrays(
            [pa.array(row[index]), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["row_id", "start", "end"]
        )

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < _ROWS:
            continue
        rows = pa.Table.from_batches(held)
        h = rows.column(0).to_numpy()
        done = int(np.searchsorted(h, h[-1]))  # the last hash may go on
        if done:
            yield compare(rows.slice(0, done))
        held = rows.slice(done).to_batches()
    if held:
        rows = pa.Table.from_batches(held)
        if rows.num_rows:
            yield compare(rows)


def _hot_stretches(texts: DataFrame, hot: np.ndarray) -> DataFrame:
    """(row_id, start, end) for windows of hot anchors, compared by 128-bit hashes of the windows."""
    shared = texts.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(2)[i].as_py().encode("utf-8", "surrogatepass")
                places, hashes, _ = anchors(data)
                places = places[_flagged(shared.value, hashes)]
                starts = np.unique((places[:, None] - np.arange(_STARTS)).ravel())
                starts = starts[(starts >= 0) & (starts + LENGTH <= len(data))]
                digests = [hashlib.blake2b(data[s : s + LENGTH], digest_size=16).digest() for s in starts.tolist()]
                same = [np.full(len(starts), batch.column(c)[i].as_py(), np.int64) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), *map(pa.array, same), pa.array(starts.astype(np.int32))], ["window", "row_id", "owner", "start"]
                )

    windows = materialise(texts.select("row_id", "owner", "text").mapInArrow(run, "window binary, row_id long, owner long, start int"), "hot-windows")
    least = windows.groupBy("window").agg(F.min("owner").alias("least"), F.max("owner").alias("most")).where("least < most")
    return windows.join(least, "window").where("owner > least").select("row_id", "start", (F.col("start") + LENGTH).alias("end"))


def repeated_stretches(texts: DataFrame, hot: int = HOT) -> DataFrame:
    """(row_id, start, end), overlapping: bytes of (row_id, owner, text) to be removed. `texts` is read twice."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]  # one number
    recurring = materialise(_recurring(texts, 1 + size // (16 << 20)), "anchors")
    counts = recurring.agg(F.count("*"), F.count_if(F.col("n") > hot)).first()
    bits = _bitmap(recurring, _log_bits(counts[0]))
    hot_bits = _bitmap(recurring.where(F.col("n") > hot), _log_bits(counts[1])) if counts[1] else None
    around = _surroundings(texts, bits, hot_bits)
    found = around.repartition("hash").sortWithinPartitions("hash").mapInArrow(_stretches, "row_id long, start int, end int")
    return found if hot_bits is None else found.unionByName(_hot_stretches(texts, hot_bits))


def remove_repeats(documents: DataFrame, hot: int = HOT, with_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]), one row per row of (doc_id, text)."""
    documents = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    owner = F.coalesce("doc_id", F.lit(int(_LAST)).cast("long"))
    classes = documents.groupBy("text").agg(F.min(owner).alias("owner"))
    classes = classes.withColumns({"digest": F.sha2(F.encode("text", "UTF-8"), 256), "row_id": F.monotonically_increasing_id()})
    classes = materialise(classes.where(F.octet_length("text") >= LENGTH), "distinct-texts")
    stretches = repeated_stretches(classes, hot)
    # Of one text these are at most its anchors.
    runs = stretches.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))

    def work(texts, runs):
        for text, cuts in zip(texts, runs, strict=True):
            data = text.encode("utf-8", "surrogatepass")
            kept, removed, spans, at = [], 0, 0, 0
            for cut in cuts:
                if cut["start"] > at or not spans:
                    kept.append(data[at : cut["start"]])
                    spans += 1
                    removed += cut["end"] - cut["start"]
                    at = cut["end"]
                elif cut["end"] > at:
                    removed += cut["end"] - at
                    at = cut["end"]
            rest = b"".join([*kept, data[at:]])
            yield removed, spans, hashlib.sha256(rest).hexdigest(), rest if with_bytes else None

    changed = annotate(
        classes.select("digest", "row_id", "text").join(runs, "row_id"), ["digest"], ["text", "runs"], work,
        "n_removed long, n_spans long, kept_sha256 string, kept binary",
    ).select("row.digest", "n_removed", "n_spans", "kept_sha256", "kept")
    rows = documents.select("doc_id", owner.alias("own"), F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"), *(["text"] if with_bytes else []))
    joined = rows.join(classes.select("digest", "owner"), "digest", "left").join(changed, "digest", "left")
    copy = F.coalesce(F.col("own") > F.col("owner"), F.lit(False))
    nothing = hashlib.sha256(b"").hexdigest()
    done = [
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
    ]
    if with_bytes:
        done.append(F.when(copy, F.lit(b"")).otherwise(F.coalesce("kept", F.encode("text", "UTF-8"))).alias("kept"))
    return joined.select(*done)


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


QUERIES = {"op7_repeated_passages": op7_repeated_passages}
SQL: dict[str, str] = {}
