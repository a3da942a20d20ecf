"""Removal of repeated passages: byte strings of 50 and more that an earlier document holds.

Every string of 50 bytes is filed under the least hash of the 20-byte strings inside it, so equal
strings are filed alike. Neighbouring strings filed alike make up one segment.

1. Every group of documents sends, for each distinct segment, a code of its least hash, a digest
   of its bytes and the first document of the group with it. The tasks of the codes find the
   first document of each segment, which owns it: every other document loses it whole. Segments
   that share a code and are unlike may still share strings of 50 bytes; they stay open.
2. Groups send the bytes of open segments from their owners. A task builds the Burrows-Wheeler
   transform of the open segments of its codes and extends intervals of suffixes backwards,
   breadth first: the suffixes that share d + 1 bytes are those of the intervals of d bytes, split
   by the byte in front. Common prefixes so come out by increasing length; intervals of one suffix
   are dropped, and the expansion stops at 50. The least document of an interval owns its string;
   all others lose it.
3. Verdicts and lost ranges return to their groups, where the bytes left are put together.

A code with very many open segments is not filed by segments but by whole strings of 50 bytes,
each of which finds its owner like a segment does.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import documents, shuffle_tasks, stored, whole_texts
from lakemart.llm.groups import GROUP_BYTES, batches_of, cut, group_rows, group_texts, grouped, pack_numbers, packed, unpack_all

LENGTH = 50
GRAM = 20
#: Verdicts on a segment of a document.
LOST, OPEN, HOT = 1, 2, 3
#: Open segments of a code beyond which it is filed by whole strings.
HOT_SEGMENTS = 4096
#: Bytes of segments that one transform covers, about, so that its arrays stay in a core's cache; a
#: code's segments stay together, so the size decides nothing else.
TRANSFORM_BYTES = 64_000
#: Lost ranges that a task gathers before it sends them on, about.
RANGES_HELD = 200_000


def gram_hashes(raw: bytes) -> np.ndarray:
    """A mixed 64-bit hash of each 20-byte string."""
    n = len(raw) - GRAM + 1
    at = lambda offset, kind: np.ndarray((n,), kind, raw, offset, (1,))
    h = at(0, "<u8") * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += at(8, "<u8")
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h += at(16, "<u4")
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


#: Odd factor of the digests, and its inverse modulo 2 ** 64.
FACTOR = 0x9FB21C651E98DF25
INVERSE = pow(FACTOR, -1, 1 << 64)


@functools.lru_cache(maxsize=64)
def powers(base: int, bits: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for all i below 2 ** bits."""
    out = np.ones(1 << bits, np.uint64)
    for bit in range(bits):
        out[1 << bit : 2 << bit] = out[: 1 << bit] * np.uint64(pow(base, 1 << bit, 1 << 64))
    return out


def segments(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of 50-byte strings that share a least hash: the hash, first and last start, digest.

    The digest is a sum of the mixed hashes of the run's 20-byte strings, each times a power of an
    odd factor that tells its place in the run.
    """
    if len(raw) < LENGTH:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes, width = gram_hashes(raw), 1
    least = hashes
    while 2 * width <= LENGTH - GRAM + 1:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    rest = LENGTH - GRAM + 1 - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.append(first[1:], len(least)) - 1
    bits = max(12, len(hashes).bit_length())
    sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes * powers(FACTOR, bits)[: len(hashes)], dtype=np.uint64)))
    digest = (sums[last + LENGTH - GRAM + 1] - sums[first]) * powers(INVERSE, bits)[first]
    digest += (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    digest ^= digest >> np.uint64(32)
    return least[first], first, last, digest


#: Bytes that the first sort of suffixes compares, and from whose intervals the expansion starts.
HEAD = 8


def heads(text: np.ndarray) -> np.ndarray:
    """The first HEAD bytes of each suffix of ``text`` (uint8) as one number."""
    padded = np.concatenate([text, np.zeros(HEAD, np.uint8)])
    key = np.zeros(len(text), np.uint64)
    for i in range(HEAD):
        key = (key << np.uint64(8)) | padded[i : i + len(text)]
    return key


def neighbours(new: np.ndarray) -> np.ndarray:
    """Members of runs of two and more; ``new`` tells where a run starts."""
    last = np.append(new[1:], True)
    return ~(new & last)


def suffix_array(head: np.ndarray, room: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Suffixes in the order of their first ``length`` bytes or more, by prefix doubling from their heads.

    Only suffixes that share their prefix with others, and have room for it, are sorted again: the
    byte 0 ends a content, so all that share a prefix beyond their room end alike. The rank of a
    suffix is the first place of those with its prefix.
    """
    n, width = len(head), HEAD
    order = np.argsort(head)
    ranked = head[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))[:n]
    places = np.arange(n)
    rank = np.full(n + 1, -1)
    rank[order] = np.maximum.accumulate(np.where(new, places, 0))
    while width < length:
        keep = neighbours(new) & (room[order[places]] >= width)
        places = places[keep]
        if not len(places):
            break
        own = order[places]
        key = (rank[own] << 32) | (rank[own + width] + 1)
        by_key = np.argsort(key)
        own, key = own[by_key], key[by_key]
        order[places] = own
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[own] = np.maximum.accumulate(np.where(new, places, 0))
        width *= 2
    return order


def shared_strings(text: np.ndarray, length: int = LENGTH, room: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts of strings of ``length`` bytes that occur twice or more, and a number for each string.

    ``length`` is at least HEAD; ``text`` holds under 2 ** 31 bytes. ``room`` is the number of bytes
    from each start to the end of its content, which the byte 0 follows; without it the text is one
    content. ``after`` leads from the rank of a suffix to that of
    the suffix a byte later: the transform's mapping, read backwards. The interval of a byte c and
    a string w is therefore the run of neighbouring ranks that start with c and lead into the
    interval of w. ``active`` are the ranks in intervals of two and more, ``number`` the interval
    of each (0: none), ``new`` where the next interval starts. As an interval lies inside that of
    any shorter prefix, nothing once dropped comes back; nor does a suffix without room.
    """
    n = len(text)
    if room is None:
        room = np.arange(n, 0, -1)
    head = heads(text)
    order = suffix_array(head, room, length)
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.arange(n)
    rank[n] = n
    after = rank[order + 1]
    ranked, left = head[order], room[order].astype(np.int32)
    active = np.arange(n)
    number = np.zeros(n + 1, np.int32)
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))[:n]
    for depth in range(min(HEAD, length), length + 1):
        if depth > HEAD:
            came = number[after]
            new[1:] |= came[1:] != came[:-1]
            new |= came == 0
        keep = neighbours(new) & (left >= depth)
        number[active] = np.where(keep, np.cumsum(new, dtype=np.int32), 0)
        # Those dropped stay so; they are taken out when they are many, or at the end.
        kept = np.count_nonzero(keep)
        if kept < 0.8 * len(active) or depth == length:
            active, after, new, left = active[keep], after[keep], new[keep], left[keep]
        if not kept:
            break
    return order[active], number[active].astype(np.int64)


def lost_in(contents: list[bytes], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of ``contents`` that consist of 50-byte strings of a content with a lesser owner.

    Returns the number of the content, start and end of each range.
    """
    used = np.zeros(256, bool)
    joined = np.frombuffer(b"".join(contents), np.uint8)
    used[joined] = True
    code = np.zeros(256, np.uint8)
    code[used] = np.arange(1, int(used.sum()) + 1)  # UTF-8 leaves bytes unused: 0 is free to end a content
    lengths = np.array([len(c) for c in contents])
    starts = np.cumsum(lengths + 1) - lengths - 1
    text = np.zeros(int(lengths.sum()) + len(contents), np.uint8)
    inside = np.ones(len(text), bool)
    inside[starts + lengths] = False
    text[inside] = code[joined]
    ends = np.repeat(starts + lengths, lengths + 1)
    at, number = shared_strings(text, room=ends - np.arange(len(text)))
    content = np.searchsorted(starts, at, "right") - 1
    whole = at + LENGTH <= (starts + lengths)[content]
    at, number, content = at[whole], number[whole], content[whole]
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    least = np.full(int(number.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, number, owners[content])
    at = np.sort(at[least[number] < owners[content]])
    # Starts that follow each other closely within one content make one range.
    content = np.searchsorted(starts, at, "right") - 1
    first = np.concatenate(([True], (at[1:] > at[:-1] + LENGTH) | (content[1:] != content[:-1]))) if len(at) else np.empty(0, bool)
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], len(at)) - 1
    return content[begin], at[begin] - starts[content[begin]], at[end[: len(begin)]] + LENGTH - starts[content[begin]]


def codes_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """The first ``width`` bytes of each hash, as numbers."""
    return hashes >> np.uint64(64 - 8 * width)


def of_document(documents: np.ndarray, names: np.ndarray) -> np.ndarray:
    """One number for each document and digest; a document's own digests never meet."""
    return names ^ (documents.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


class Deduplication:
    """The steps over one set of documents; ``grouped`` has (doc_id, text, grp)."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, hot_segments: int = HOT_SEGMENTS):
        self.hot_segments = hot_segments
        spark = docs.sparkSession
        rows = whole_texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
        self.grouped, total = grouped(rows)
        #: As many as groups, however the session is set, so that no task grows with the documents.
        self.tasks = max(shuffle_tasks(spark), -(-total // GROUP_BYTES))
        #: Wide enough that unlike hashes rarely share a code, which only leaves more segments open.
        self.width = min(8, ((total // 16).bit_length() + 6 + 7) // 8)

    def verdicts(self) -> DataFrame:
        """(grp, verdicts): segments that documents lose or hold open, by id and digest."""
        tasks, width, hot_segments = self.tasks, self.width, self.hot_segments

        def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held = [(np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
                for doc, text, group in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if doc is not None:
                        least, _, _, digest = segments(text.encode("utf-8", "surrogatepass"))
                        held.append((codes_of(least, width), digest, np.full(len(least), doc), np.full(len(least), group)))
                code, digest, doc, group = (np.concatenate(x) for x in zip(*held, strict=True))
                order = np.lexsort((doc, digest, group))
                first = np.ones(len(order), bool)
                d, g = digest[order], group[order]
                first[1:] = (d[1:] != d[:-1]) | (g[1:] != g[:-1])
                order = order[first]
                out = [
                    (task, pack_numbers((code[own], width), (digest[own], 8), (doc[own], 8), (group[own], 4)))
                    for task, at in cut(code[order] % np.uint64(tasks))
                    if len(own := order[at])
                ]
                yield batches_of("task int, blob binary", [t for t, _ in out], [b for _, b in out])

        def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            code, digest, doc, group = unpack_all((b for batch in batches for b in batch.column(1).to_pylist()), width, 8, 8, 4)
            doc = doc.view(np.int64)
            order = np.lexsort((doc, digest, code))
            code, digest, doc, group = code[order], digest[order], doc[order], group[order].astype(np.int64)
            if not len(code):
                return
            new_code = np.concatenate(([True], code[1:] != code[:-1]))
            new = new_code | np.concatenate(([True], digest[1:] != digest[:-1]))
            content = np.cumsum(new) - 1
            owner = doc[np.flatnonzero(new)][content]
            number = np.cumsum(new_code) - 1
            contents = np.bincount(number[new])[number]
            verdict = np.where(doc > owner, LOST, np.where(contents > hot_segments, HOT, np.where(contents > 1, OPEN, 0)))
            told = verdict > 0
            digest, doc, group, verdict = digest[told], doc[told], group[told], verdict[told]
            found = [(g, pack_numbers((doc[at], 8), (digest[at], 8), (verdict[at], 1))) for g, at in cut(group)]
            yield batches_of("grp int, verdicts binary", [g for g, _ in found], [b for _, b in found])

        sent = self.grouped.mapInArrow(send, "task int, blob binary")
        return sent.repartition(tasks, "task").mapInArrow(judge, "grp int, verdicts binary")

    def lost_ranges(self, verdicts: DataFrame) -> DataFrame:
        """(grp, ranges): what documents lose of segments and strings that were open, by id and digest."""
        tasks, width = self.tasks, self.width

        def send(texts: pa.Table, verdicts: pa.Table) -> pa.Table:
            doc, digest, verdict = unpack_all(verdicts.column("verdicts").to_pylist(), 8, 8, 1)
            open_, hot = (np.sort(of_document(doc[at], digest[at])) for at in (verdict == OPEN, verdict == HOT))
            wanted = set(doc.view(np.int64)[verdict != LOST].tolist())
            out: dict[int, list[tuple]] = {}
            for i, raw in group_rows(texts):
                if i not in wanted:
                    continue
                least, first, last, digest = segments(raw)
                key, code, sent = of_document(np.full(len(least), i), digest), codes_of(least, width), set()
                for at in np.flatnonzero(member(key, open_)).tolist():
                    if digest[at] not in sent:
                        sent.add(digest[at])
                        c = int(code[at])
                        out.setdefault(c % tasks, []).append((c, raw[first[at] : last[at] + LENGTH], i, int(digest[at])))
                for at in np.flatnonzero(member(key, hot)).tolist():
                    for start in range(first[at], last[at] + 1):
                        whole = raw[start : start + LENGTH]
                        c = xxhash.xxh64_intdigest(whole)
                        if c not in sent:
                            sent.add(c)
                            out.setdefault(c % tasks, []).append((c, whole, i, c))
            group = texts.column("grp")[0].as_py() if texts.num_rows else 0
            blobs = []
            for held in out.values():
                held.sort(key=lambda e: e[:2])
                c, s, d, h = zip(*held, strict=True)
                blobs.append(packed(
                    code=pa.array(c, pa.uint64()), content=pa.array(s, pa.binary()), doc_id=pa.array(d, pa.int64()), digest=pa.array(h, pa.uint64())
                ))
            return pa.Table.from_batches([batches_of("task int, grp int, blob binary", [*out], [group] * len(out), blobs)])

        def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sent = [(row["grp"], row["blob"]) for batch in batches for row in batch.to_pylist()]
            if not sent:
                return
            tables = [pa.ipc.open_stream(blob).read_all() for _, blob in sent]
            group = np.repeat([g for g, _ in sent], [t.num_rows for t in tables])
            table = pa.concat_tables(tables).combine_chunks()
            code, doc, digest = (table.column(n).to_numpy() for n in ("code", "doc_id", "digest"))
            order = np.argsort(code, kind="stable")
            size = pa.compute.binary_length(table.column("content")).to_numpy()[order]
            same = np.concatenate((code[order][1:] == code[order][:-1], [False]))
            before = np.concatenate(([0], np.cumsum(size)))
            held: list[tuple[np.ndarray, ...]] = []
            ranges = 0

            def told() -> Iterator[pa.RecordBatch]:
                rows, starts, ends = (np.concatenate(x) for x in zip(*held, strict=True))
                for g, own in cut(group[rows]):
                    yield batches_of("grp int, ranges binary", [g], [
                        pack_numbers((doc[rows[own]], 8), (digest[rows[own]], 8), (starts[own], 8), (ends[own], 8))
                    ])

            at = 0
            while at < len(order):  # whole codes, up to TRANSFORM_BYTES
                end = max(at + 1, int(np.searchsorted(before, before[at] + TRANSFORM_BYTES)))
                while end < len(order) and same[end - 1]:
                    end += 1
                end = min(end, len(order))
                part = order[at:end]
                at = end
                rows, starts, ends = lost_in(table.column("content").take(pa.array(part)).to_pylist(), doc[part])
                held.append((part[rows], starts, ends))
                ranges += len(rows)
                if ranges >= RANGES_HELD:
                    yield from told()
                    held, ranges = [], 0
            if held:
                yield from told()

        opened = group_texts(self.grouped).groupBy("grp").cogroup(verdicts.groupBy("grp")).applyInArrow(send, "task int, grp int, blob binary")
        return opened.repartition(tasks, "task").mapInArrow(judge, "grp int, ranges binary")

    def remaining(self, verdicts: DataFrame, ranges: DataFrame) -> DataFrame:
        """(doc_id, n_bytes, n_removed, n_spans, kept) with the bytes left of every document."""
        schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"

        def remove(texts: pa.Table, told: pa.Table) -> pa.Table:
            if not texts.num_rows:
                return pa.Table.from_batches([batches_of(schema, *[[]] * 5)])
            doc, digest, verdict = unpack_all((b for b in told.column("verdicts").to_pylist() if b is not None), 8, 8, 1)
            lost, hot = (np.sort(of_document(doc[at], digest[at])) for at in (verdict == LOST, verdict == HOT))
            doc, digest, start, end = unpack_all((b for b in told.column("ranges").to_pylist() if b is not None), 8, 8, 8, 8)
            parts: dict[int, list[tuple[int, int]]] = {}
            for name, a, b in zip(of_document(doc, digest).tolist(), start.tolist(), end.tolist(), strict=True):
                parts.setdefault(name, []).append((a, b))
            partial = np.sort(np.fromiter(parts, np.uint64, len(parts)))
            rows = [(i, raw, *segments(raw)[1:]) for i, raw in group_rows(texts)]
            # The first document of the group with a segment; the others lose it.
            of_row = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
            ids = np.array([r[0] for r in rows], np.int64)
            digests = np.concatenate([r[4] for r in rows]) if rows else np.empty(0, np.uint64)
            _, first, place = np.unique(digests, return_index=True, return_inverse=True)
            local = ids[of_row] > ids[of_row[first]][place] if rows else np.empty(0, bool)
            out, at = {}, 0
            for i, raw, starts, lasts, names in rows:
                key = of_document(np.full(len(names), i), names)
                whole = local[at : at + len(names)] | member(key, lost)
                at += len(names)
                edges = np.zeros(len(raw) + 1, np.int64)
                np.add.at(edges, starts[whole], 1)
                np.add.at(edges, lasts[whole] + LENGTH, -1)
                for k in np.flatnonzero(member(key, partial)).tolist():
                    for a, b in parts[int(key[k])]:
                        edges[starts[k] + a] += 1
                        edges[starts[k] + b] -= 1
                for k in np.flatnonzero(member(key, hot)).tolist():
                    for s in range(starts[k], lasts[k] + 1):
                        name = np.array([xxhash.xxh64_intdigest(raw[s : s + LENGTH])], np.uint64)
                        if int(of_document(np.array([i]), name)[0]) in parts:
                            edges[s] += 1
                            edges[s + LENGTH] -= 1
                gone = np.cumsum(edges[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out[i, raw] = (i, len(raw), len(raw) - len(kept), spans, kept)
            result = [
                out.get((i, raw), (i, len(raw), 0, 0, raw))
                for blob in texts.column("texts").to_pylist()
                for i, raw in zip(*(c.to_pylist() for c in pa.ipc.open_stream(blob).read_all().columns), strict=True)
            ]
            return pa.Table.from_batches([batches_of(schema, *map(list, zip(*result, strict=True)))])

        none = F.lit(None).cast("binary")
        told = verdicts.select("grp", "verdicts", none.alias("ranges")).unionAll(ranges.select("grp", none, "ranges"))
        return group_texts(self.grouped).groupBy("grp").cogroup(told.groupBy("grp")).applyInArrow(remove, schema)


def member(keys: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Which ``keys`` the sorted array holds."""
    if not len(ranked):
        return np.zeros(len(keys), bool)
    return ranked[np.minimum(np.searchsorted(ranked, keys), len(ranked) - 1)] == keys


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_segments: int = HOT_SEGMENTS,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` are the bytes left.

    A byte goes where a 50-byte string over it also starts in a document with a smaller id.
    A null text counts as empty. Rows that share an id do not take from each other; a row with
    a null id neither takes nor loses. Texts under 50 bytes stay as they are, an empty table gives
    no rows, other columns are not read. Ids must be whole numbers.
    """
    steps = Deduplication(docs, id_col, text_col, hot_segments)
    verdicts = stored(steps.verdicts(), "segment-verdicts")
    ranges = stored(steps.lost_ranges(verdicts), "lost-ranges")
    return steps.remaining(verdicts, ranges)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of all documents."""
    return without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
