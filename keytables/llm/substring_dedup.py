"""Repeated passages by suffix automata of reference shards.

A window is so many consecutive words of one document. Words covered by a window that also starts in a document with
a smaller id are removed. The work is done on bundles, compressed batches of about 1 MB of text, so that rows that
move are few and alike in size:

1. Every window is represented by its minimizer, the sub-shingle with the least hash. Bundles tell which minimizers
   they have, once each with the smallest and largest document; what comes back is, for each that several documents
   have, the smallest of these, and its bundle.
2. The passages of these smallest documents are the reference, and each bundle's are a shard of it. A shard becomes a
   suffix automaton of words, which is sent to the tasks that stream the passages pointing to it; a shard that many
   point to is sent to several. Matching statistics give the windows found in a smaller document.
3. A window whose minimizer is in a smaller document, but which is not in that one, may still be in another. Those
   few are compared with one another by hash.
4. Removed ranges go back to their bundles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from keytables.llm.frames import extended, sorted_runs, tidy
from keytables.llm.words import Words, inside, join_kept, pieces, shingle_hashes, split_words, word_hashes
from keytables.sources.scratch import write_scratch

# Passages streamed through one copy of a shard, in words; a shard with more is sent to several tasks.
STREAM_WORDS = 150_000
# Bytes of text in a bundle. Minimizers told in one go, and bundles for each part that they are dealt to.
BUNDLE_BYTES = 1024 * 1024
TOLD, BUNDLES_A_PART = 250_000, 4


class SuffixAutomaton:
    """The suffix automaton of passages, sequences of non-negative integers, added by rising document id.

    The document in which a state's strings end first is the smallest that has them, as passages come in order.
    """

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.first = [-1], [0], [-1]
        self._ends = 0

    def add(self, symbols: list[int], document: int) -> None:
        nxt, link, size, first = self.next, self.link, self.size, self.first
        last = 0
        self._ends -= 1  # a symbol of its own ends each passage, so that none runs on into the next
        for c in [*symbols, self._ends]:
            known = nxt[last].get(c)
            if known is not None:  # the string is there already
                if size[known] == size[last] + 1:
                    last = known
                else:
                    last = self._split(last, c, known)
                continue
            state = len(nxt)
            nxt.append({})
            size.append(size[last] + 1)
            first.append(document)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = state
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[state] = q if size[q] == size[p] + 1 else self._split(p, c, q)
            last = state

    def _split(self, p: int, c: int, q: int) -> int:
        nxt, link, size, first = self.next, self.link, self.size, self.first
        clone = len(nxt)
        nxt.append(nxt[q].copy())
        size.append(size[p] + 1)
        first.append(first[q])
        link.append(link[q])
        link[q] = clone
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def windows(self, symbols: list[int], window: int, none: int | None = -1) -> list[int | None]:
        """For each window of ``symbols``, the smallest document that has it, or ``none``."""
        nxt, link, size, first = self.next, self.link, self.size, self.first
        out = []
        v = n = 0
        for c in symbols:
            to = nxt[v].get(c)
            while to is None and v:
                v = link[v]
                n = size[v]
                to = nxt[v].get(c)
            if to is None:
                v = n = 0
            else:
                v = to
                n += 1
                while size[link[v]] >= window:  # no longer match than a window need be kept
                    v = link[v]
                    n = size[v]
            out.append(first[v] if n >= window else none)
        return out[window - 1 :]


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return zstandard.compress(sink.getvalue(), 3)


def _unpack(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.decompress(raw)).read_all().combine_chunks()


def _bundles(documents: DataFrame) -> DataFrame:
    """``bundle, rows`` with about 1 MB of text each, or one longer document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal n
            n += 1
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([pa.array([part * (1 << 32) + n]), pa.array([_pack(whole)])], ["bundle", "rows"])

        for batch in batches:
            for piece in pieces(batch, "text", BUNDLE_BYTES // 4):
                if held and size + piece.nbytes > BUNDLE_BYTES:
                    yield flush()
                    held, size = [], 0
                held.append(piece)
                size += piece.nbytes
        if held:
            yield flush()

    return documents.mapInArrow(tidy(run), "bundle long, rows binary")


class _Windows:
    """The windows of a bundle and their minimizers."""

    def __init__(self, table: pa.Table, window: int, sub: int):
        self.ids = table["doc_id"].combine_chunks()
        self.words: Words = split_words(table["text"])
        self.hashes = word_hashes(self.words)
        known = np.array(self.ids.is_valid())
        ids = self.ids.fill_null(0).to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(ids)), self.words.count)
        n = max(len(self.hashes) - window + 1, 0)
        self.owner = owner[:n]
        self.valid = inside(self.words, window) & known[self.owner]
        self.document = ids[self.owner]
        subs = shingle_hashes(self.hashes, sub)
        self.minimizer = subs[:n].copy()
        for j in range(1, window - sub + 1):
            np.minimum(self.minimizer, subs[j : j + n], out=self.minimizer)

    def told(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct minimizers in order, and the smallest and the largest document of each."""
        m, d = self.minimizer[self.valid], self.document[self.valid]
        # Neighbouring windows mostly share their minimizer.
        change = np.ones(len(m), bool)
        change[1:] = (m[1:] != m[:-1]) | (d[1:] != d[:-1])
        m, d = m[change], d[change]
        order = np.lexsort((d, m))
        m, d = m[order], d[order]
        first = np.flatnonzero(np.concatenate(([True], m[1:] != m[:-1]))) if len(m) else np.empty(0, np.int64)
        last = np.append(first[1:], len(m)) - 1 if len(m) else first
        return m[first], d[first], d[last]


def _blob(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


def _array(raw: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), dtype)


def _tell(parts: int, window: int, sub: int):
    """From bundles to rows of ``part``: which minimizers which bundles have, and in which documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            bundle, m, low, high, at = (np.concatenate(x) for x in zip(*held))
            part = (m % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            groups = np.split(order, cuts) if len(order) else []
            columns = [[_blob(x[g]) for g in groups] for x in (bundle, m, low, high - low, at)]
            return pa.RecordBatch.from_arrays(
                [pa.array([int(part[g[0]]) for g in groups], pa.int64()), *(pa.array(c, pa.binary()) for c in columns)],
                ["part", "bundles", "minimizers", "low", "spread", "places"],
            )

        for batch in batches:
            for bundle, rows in zip(batch["bundle"].to_pylist(), batch["rows"]):
                m, low, high = _Windows(_unpack(rows.as_buffer()), window, sub).told()
                held.append((np.full(len(m), bundle), m, low, high, np.arange(len(m), dtype=np.int32)))
                if sum(len(x[1]) for x in held) >= TOLD:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    return run


def _answer(table: pa.Table) -> pa.Table:
    """For each bundle of a part: the places of its minimizers that several documents have, the smallest of these
    documents and its bundle."""
    bundle, low, spread = (np.concatenate([_array(x.as_buffer(), np.int64) for x in table[c]]) for c in ("bundles", "low", "spread"))
    m = np.concatenate([_array(x.as_buffer(), np.uint64) for x in table["minimizers"]])
    places = np.concatenate([_array(x.as_buffer(), np.int32) for x in table["places"]])
    order = np.lexsort((bundle, low, m))
    m, low, high, bundle, places = m[order], low[order], (low + spread)[order], bundle[order], places[order]
    start = np.concatenate(([True], m[1:] != m[:-1]))
    group = np.cumsum(start) - 1
    begin = np.flatnonzero(start)
    several = np.maximum.reduceat(high, begin) > low[begin]
    hot = np.flatnonzero(several[group])
    first = begin[group[hot]]
    by = np.argsort(bundle[hot], kind="stable")
    hot, first = hot[by], first[by]
    names, cuts = np.unique(bundle[hot], return_index=True)
    runs = np.split(np.arange(len(hot)), cuts[1:]) if len(hot) else []
    return pa.table(
        {
            "bundle": pa.array(names, pa.int64()),
            "places": pa.array([_blob(places[hot[r]]) for r in runs], pa.binary()),
            "firsts": pa.array([_blob(low[first[r]]) for r in runs], pa.binary()),
            "shards": pa.array([_blob(bundle[first[r]]) for r in runs], pa.binary()),
        }
    )


def _passages(window: int, sub: int):
    """From bundles with their answers to the passages that are reference, and those to be looked up in a shard."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, rows, answers in zip(batch["bundle"].to_pylist(), batch["rows"], batch["answers"].to_pylist()):
                w = _Windows(_unpack(rows.as_buffer()), window, sub)
                told = w.told()[0]
                first, shard = np.full(len(told), -1), np.full(len(told), -1)
                hot = np.zeros(len(told), bool)
                for a in answers:
                    places = _array(a["places"], np.int32)
                    first[places], shard[places] = _array(a["firsts"], np.int64), _array(a["shards"], np.int64)
                    hot[places] = True
                n = len(w.minimizer)
                at = np.searchsorted(told, w.minimizer) if len(told) else np.zeros(n, np.int64)
                at = np.minimum(at, max(len(told) - 1, 0))
                good = w.valid & (hot[at] if len(told) else np.zeros(n, bool))
                mine = first[at] if len(told) else np.zeros(n, np.int64)
                for reference in (True, False):
                    use = good & (mine == w.document if reference else mine < w.document)
                    where = shard[at] if len(told) else mine
                    change = np.ones(n, bool)
                    change[1:] = ~use[:-1] | (w.owner[1:] != w.owner[:-1]) | (where[1:] != where[:-1])
                    begin = np.flatnonzero(use & change)
                    if not len(begin):
                        continue
                    stop = np.ones(n, bool)
                    stop[:-1] = ~use[1:] | change[1:]
                    end = np.flatnonzero(use & stop) + window  # the words of a run of windows
                    raw = w.words.data.tobytes()
                    text = [raw[a:b] for a, b in zip(w.words.start[begin].tolist(), w.words.end[end - 1].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            # To the shard that the others ask, also where several rows have the smallest id.
                            pa.array(where[begin]),
                            pa.array(np.full(len(begin), not reference)),
                            pa.array(np.full(len(begin), bundle)),
                            pa.array(w.owner[begin].astype(np.int32)),
                            pa.array(w.document[begin]),
                            pa.array((begin - w.words.first[w.owner[begin]]).astype(np.int32)),
                            pa.array((end - begin).astype(np.int32)),
                            pa.array(text, pa.binary()),
                        ],
                        ["shard", "asks", "bundle", "row", "doc", "at", "n", "text"],
                    )

    return run, "shard long, asks boolean, bundle long, row int, doc long, at int, n int, text binary"


def _match(window: int):
    """Per shard and copy: ranges of words to remove, and windows that must be looked for elsewhere."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_runs(batches, ["shard", "copy"]):
            asks = group["asks"].to_numpy()
            words = split_words(group["text"].combine_chunks())
            hashes = word_hashes(words)
            document, first = group["doc"].to_numpy(), words.first
            reference = np.flatnonzero(~asks)
            inner = np.zeros(len(hashes) + 1, np.int8)
            np.add.at(inner, first[reference], 1)
            np.add.at(inner, first[reference + 1], -1)
            alphabet = np.unique(hashes[np.cumsum(inner[:-1]).astype(bool)])
            code = np.searchsorted(alphabet, hashes)
            if len(alphabet):
                code = np.where(alphabet[np.minimum(code, len(alphabet) - 1)] == hashes, code, len(alphabet))
            automaton = SuffixAutomaton()
            for r in reference[np.argsort(document[reference], kind="stable")].tolist():
                automaton.add(code[first[r] : first[r + 1]].tolist(), int(document[r]))
            shingles = shingle_hashes(hashes, window)
            found: list[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]] = []
            for q in np.flatnonzero(asks).tolist():
                least = int(document[q])
                smallest = automaton.windows(code[first[q] : first[q + 1]].tolist(), window, None)
                gone = np.array([x is not None and x < least for x in smallest], bool)
                edge = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
                begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + window - 1
                found.append((q, begin, end, None))
                rest = np.flatnonzero(~gone)
                if len(rest):
                    found.append((q, rest, rest + window, shingles[first[q] + rest].view(np.int64)))
            if not found:
                continue
            q = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
            at = group["at"].to_numpy()[q]
            known = np.concatenate([np.full(len(f[1]), f[3] is None) for f in found])
            hashed = np.concatenate([np.zeros(len(f[1]), np.int64) if f[3] is None else f[3] for f in found])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group["bundle"].to_numpy()[q]),
                    pa.array(group["row"].to_numpy()[q]),
                    pa.array(document[q]),
                    pa.array((at + np.concatenate([f[1] for f in found])).astype(np.int32)),
                    pa.array((at + np.concatenate([f[2] for f in found])).astype(np.int32)),
                    pa.array(hashed, mask=known),
                ],
                ["bundle", "row", "doc", "begin", "end", "window"],
            )

    return run, "bundle long, row int, doc long, begin int, end int, window long"


def remove_repeats(documents: DataFrame, window: int = 13, sub: int = 8, join_always: bool = False) -> DataFrame:
    """``documents`` with the words removed that repeat a smaller document, and ``n_words, n_removed``.

    A word is removed if it is covered by ``window`` consecutive words that also start in a document with a smaller
    ``doc_id``; this is judged on the input. A text of which words were removed is its other words joined by one space;
    others stay as they are, unless ``join_always``, which joins the words of all. A null text has no words and
    stays null, without ``join_always``. Rows that share a ``doc_id`` do not remove each other's words; a row with
    a null ``doc_id`` neither loses nor removes any. Texts shorter than a window stay whole. Columns named
    ``n_words`` and ``n_removed`` are replaced. ``doc_id`` is an integer.
    """
    if not 0 < sub <= window:
        raise ValueError("sub must be from 1 to window")
    own = ["n_words", "n_removed"]
    documents = documents.drop(*own)
    bundles = write_scratch(_bundles(documents), "repeats-bundles")
    parts = max(8, bundles.count() // BUNDLES_A_PART)
    told = "part long, bundles binary, minimizers binary, low binary, spread binary, places binary"
    answers = (
        bundles.mapInArrow(tidy(_tell(parts, window, sub)), told)
        .groupBy("part")
        .applyInArrow(_answer, "bundle long, places binary, firsts binary, shards binary")
        .groupBy("bundle")
        .agg(F.collect_list(F.struct("places", "firsts", "shards")).alias("answers"))
    )
    run, schema = _passages(window, sub)
    passages = write_scratch(bundles.join(answers, on="bundle").mapInArrow(tidy(run), schema), "repeats-passages")

    # A shard is copied for as many tasks as the words to be streamed through it call for.
    asked = passages.where("asks").groupBy("shard").agg(F.ceil(F.sum("n") / STREAM_WORDS).cast("int").alias("copies"))
    asked = write_scratch(asked, "repeats-shards")
    sized = passages.join(asked, on="shard")
    own_copy = F.array(F.pmod(F.xxhash64("bundle", "row", "at"), F.col("copies")).cast("int"))
    copies = F.when(F.col("asks"), own_copy).otherwise(F.sequence(F.lit(0), F.col("copies") - 1))
    match, schema = _match(window)
    found = (
        sized.withColumn("copy", F.explode(copies))
        .drop("copies", "n")
        .repartition("shard", "copy")
        .sortWithinPartitions("shard", "copy")
        .mapInArrow(tidy(match), schema)
    )
    found = write_scratch(found, "repeats-found")
    open_ = found.where("window is not null")
    least = open_.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    least = write_scratch(least.select("window", "least"), "repeats-windows")
    ranges = found.where("window is null").select("bundle", "row", "begin", "end")
    ranges = ranges.unionByName(open_.join(least, on="window").where("doc > least").select("bundle", "row", "begin", "end"))
    removed = ranges.groupBy("bundle").agg(F.collect_list(F.struct("row", "begin", "end")).alias("ranges"))
    names = documents.columns

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                table = _unpack(batch["rows"][i].as_buffer())
                words = split_words(table["text"])
                gone = np.zeros(len(words.start) + 1, np.int32)
                found = batch["ranges"][i]
                if found.is_valid and len(found.values):
                    row, begin, end = (found.values.field(k).to_numpy() for k in ("row", "begin", "end"))
                    np.add.at(gone, words.first[row] + begin, 1)
                    np.add.at(gone, words.first[row] + end, -1)
                gone = np.cumsum(gone[:-1]) > 0
                lost = np.add.reduceat(np.append(gone, False), words.first[:-1]) * (words.count > 0)
                raw, ends = join_kept(words, ~gone)
                raw = raw.tobytes()
                kept = [raw[a:b].decode() for a, b in ends.tolist()]
                if not join_always:
                    old = table["text"].to_pylist()
                    kept = [k if n else o for k, n, o in zip(kept, lost.tolist(), old)]
                columns = [pa.array(kept, pa.string()) if c == "text" else table[c].combine_chunks() for c in names]
                counts = [pa.array(words.count.astype(np.int64)), pa.array(lost.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*columns, *counts], [*names, *own])

    out = extended(documents.schema, n_words=LongType(), n_removed=LongType())
    return bundles.join(removed, on="bundle", how="left").select("rows", "ranges").mapInArrow(tidy(finish), out)
