"""Near-duplicate documents by MinHash: universal hash minima, banding, verification, components.

Documents with equal shingle sets are one node from the start. Nodes that share a band's minima are a bucket.
Every node is first compared with its bucket's most copied node alone, which finds the links that hold a group of
copies together without listing its pairs. What is then still apart in a bucket is compared pair by pair, so no
bucket is cut short and no candidate is dropped: in small buckets the candidate pairs are rows, in large ones they
are verified on the spot, in blocks of bounded size, and only links come out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytables.llm.components import connected_components
from keytables.llm.frames import sorted_runs, tidy
from keytables.llm.words import inside, mix, pieces, shingle_hashes, split_words, word_hashes
from keytables.sources.scratch import write_scratch

# Bands at a similarity of 0.85 or more; below that there are so many more (37 at 0.8) that a pair at the threshold
# shares none with a probability of at most MISSED, too: 4e-7 at both.
BANDS, BAND_ROWS, MISSED = 25, 5, 5e-7
# Signatures have the minima of the first BANDS bands, however many bands there are.
MINIMA = BANDS * BAND_ROWS
LEAST_SIMILARITY = 80
# Signatures keep 8 bits of each minimum. A pair at the threshold agrees in fewer of them than is asked for, so many
# standard deviations below what is expected, with a probability of 1e-5; at 0.85 that is 88 of 125.
AGREEING_DEVIATIONS = 4.6
# Buckets of more nodes than this give no candidate pairs, but links; so many nodes of one are compared in one go.
SMALL, BLOCK = 32, 2048


def bands_for(similarity: int) -> int:
    """How many bands pairs of ``similarity`` per cent call for."""
    apart = 1 - (similarity / 100) ** BAND_ROWS
    return max(BANDS, math.ceil(math.log(MISSED) / math.log(apart))) if apart else BANDS


_rng = np.random.default_rng(11)
_FACTOR = _rng.integers(1, 2**31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSET = _rng.integers(0, 2**32, MINIMA, dtype=np.uint64).astype(np.uint32)
_more = bands_for(LEAST_SIMILARITY) * BAND_ROWS - MINIMA
_FACTOR = np.append(_FACTOR, _rng.integers(1, 2**31, _more, dtype=np.uint32) * np.uint32(2) + np.uint32(1))
_OFFSET = np.append(_OFFSET, _rng.integers(0, 2**32, _more, dtype=np.uint64).astype(np.uint32))


def shingle_sets(texts: pa.Array, size: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one text after the other, and where each begins.

    A text with fewer than ``size`` words has its whole sequence as one shingle; one without words none.
    """
    words = split_words(texts, lower)
    hashes = word_hashes(words)
    windows = shingle_hashes(hashes, size)
    valid = inside(words, size)
    owner = np.repeat(np.arange(len(texts)), words.count)
    values, owners = windows[valid], owner[: len(windows)][valid]
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    if len(short):
        whole = np.array(
            [mix(shingle_hashes(hashes[words.first[d] : words.first[d + 1]], int(words.count[d])) + np.uint64(words.count[d]))[0] for d in short],
            np.uint64,
        )
        values, owners = np.concatenate([values, whole]), np.concatenate([owners, short])
    counts = np.bincount(owners, minlength=len(texts))
    order = np.argsort(owners, kind="stable") if len(short) else None
    values = values if order is None else values[order]
    ends = np.cumsum(counts)
    out = [np.unique(values[e - c : e]) for e, c in zip(ends.tolist(), counts.tolist())]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in out], out=offsets[1:])
    return np.concatenate(out) if out else np.empty(0, np.uint64), offsets


def node_ids(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set; 0 for the empty one."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values), dtype=np.uint64)])
    counts = np.diff(offsets).astype(np.uint64)
    ids = mix((sums[offsets[1:]] - sums[offsets[:-1]]) * np.uint64(0x9E3779B97F4A7C15) + counts)
    return np.where(counts > 0, ids, np.uint64(0)).view(np.int64)


def signatures(values: np.ndarray, offsets: np.ndarray, minima: int = MINIMA) -> np.ndarray:
    """The minima of ``minima`` universal hash functions over each non-empty set; one row per set."""
    full = np.flatnonzero(np.diff(offsets) > 0)
    out = np.zeros((len(offsets) - 1, minima), np.uint32)
    if len(full):
        x = (values >> np.uint64(32)).astype(np.uint32)
        for j in range(minima):
            out[full, j] = np.minimum.reduceat(x * _FACTOR[j] + _OFFSET[j], offsets[full])
    return out


def _band_keys(sig: np.ndarray) -> np.ndarray:
    bands = sig.shape[1] // BAND_ROWS
    keys = np.zeros((len(sig), bands), np.uint64)
    parts = sig.astype(np.uint64).reshape(len(sig), bands, BAND_ROWS)
    for j in range(BAND_ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j] + np.uint64(1))
    return mix(keys + np.arange(bands, dtype=np.uint64)).view(np.int64)


def _features(documents: DataFrame, size: int, n_bands: int, id_type: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                values, offsets = shingle_sets(piece["text"], size)
                counts = np.diff(offsets)
                sig = signatures(values, offsets, n_bands * BAND_ROWS)
                bands = np.where(counts > 0, n_bands, 0)
                ends = np.concatenate(([0], np.cumsum(bands))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece["doc_id"],
                        piece["row"],
                        pa.array(node_ids(values, offsets)),
                        pa.array(counts),
                        pa.array([row.tobytes() for row in sig[:, :MINIMA].astype(np.uint8)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(_band_keys(sig)[counts > 0].ravel())),
                    ],
                    ["doc_id", "row", "node", "n_shingles", "signature", "bands"],
                )

    schema = f"doc_id {id_type}, row long, node long, n_shingles long, signature binary, bands array<long>"
    return documents.select("doc_id", "row", "text").mapInArrow(tidy(run), schema)


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """``node, shingles`` of rows with ``node, text``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                values, offsets = shingle_sets(piece["text"], size)
                node = node_ids(values, offsets)
                # Should two rows have one hash, their texts are still different nodes.
                same = pa.array(node == piece["node"].to_numpy(zero_copy_only=False))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(node), lists], ["node", "shingles"]).filter(same)

    return rows.select("node", "text").mapInArrow(tidy(run), "node long, shingles array<long>")


def least_agreeing(similarity: int) -> int:
    """In how many minima two sets must agree to be looked at more closely."""
    p = similarity / 100
    return round(MINIMA * p - AGREEING_DEVIATIONS * (MINIMA * p * (1 - p)) ** 0.5)


def _agreeing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """In how many minima each row of ``left`` agrees with each row of ``right``."""
    out = np.zeros((len(left), len(right)), np.uint8)
    for j in range(MINIMA):
        out += left[:, j, None] == right[None, :, j]
    return out


def _apart(similarity: int):
    """Candidate pairs of different components within each run of equal ``bucket, i, j``, rows being sorted."""
    least = least_agreeing(similarity)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_runs(batches, ["bucket", "i", "j"]):
            sig = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(-1, MINIMA)
            node, comp, n = (group[c].to_numpy() for c in ("node", "component", "n_shingles"))
            _, code, members = np.unique(comp, return_inverse=True, return_counts=True)
            # Pairs within the largest component need no look.
            rest = np.flatnonzero(code != members.argmax())
            near = (_agreeing(sig[rest], sig) >= least) & (code[rest][:, None] != code[None, :])
            near &= 100 * np.minimum(n[rest][:, None], n) >= similarity * np.maximum(n[rest][:, None], n)
            x, y = np.nonzero(near)
            if len(x):
                p, q = node[rest[x]], node[y]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], ["a", "b"])

    return run


def _links_apart(similarity: int):
    """The links between different components within each run of equal ``bucket, i, j``, rows being sorted.

    A pair is looked at in the first bucket that it shares, the likeliest of a node's pairs first, and once two
    components are linked, no more pairs of theirs are looked at.
    """
    least, n_bands = least_agreeing(similarity), bands_for(similarity)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_runs(batches, ["bucket", "i", "j"]):
            sig = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(-1, MINIMA)
            bands = group["bands"].combine_chunks().flatten().to_numpy().reshape(-1, n_bands)
            lists = group["shingles"].combine_chunks()
            values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            node, comp, block, n = (group[c].to_numpy() for c in ("node", "component", "block", "n_shingles"))
            here = int(np.flatnonzero(bands[0] == group["bucket"][0].as_py())[0])
            across = group["i"][0].as_py() != group["j"][0].as_py()
            _, code, members = np.unique(comp, return_inverse=True, return_counts=True)
            found: list[tuple[int, int]] = []
            for x in np.flatnonzero(code != members.argmax()).tolist():
                others = np.flatnonzero(
                    (code != code[x])
                    & (100 * np.minimum(n[x], n) >= similarity * np.maximum(n[x], n))
                    & ~(bands[:, :here] == bands[x, :here]).any(axis=1)
                    & (~across | (block != block[x]))
                )
                agree = (sig[others] == sig[x]).sum(axis=1)
                others, agree = others[agree >= least], agree[agree >= least]
                mine = values[ends[x] : ends[x + 1]]
                for y in others[np.argsort(-agree, kind="stable")].tolist():
                    if code[y] == code[x]:
                        continue
                    theirs = values[ends[y] : ends[y + 1]]
                    at = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
                    both = int((theirs[at] == mine).sum())
                    if 100 * both >= similarity * (len(mine) + len(theirs) - both):
                        found.append((int(node[x]), int(node[y])))
                        code[code == code[x]] = code[y]
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def near_duplicates(documents: DataFrame, size: int = 5, similarity: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: the near-duplicate group of each row of ``documents``.

    Texts are compared as sets of shingles of ``size`` words, A-Z lower-cased; those are linked
    whose Jaccard similarity is at least ``similarity`` per cent, on full sets, and at least 80.
    ``component_id`` is the smallest ``doc_id`` that links lead to; ``kept`` says whether that is the row's
    own. Null, empty and blank texts have no shingle and link with nothing; a text shorter than a shingle equals only
    the same sequence of words. Rows with one ``doc_id`` and different texts are judged apart; repeated rows
    each give a row. A row with a null ``doc_id`` links like any other, but gives way to rows with one; in a group of
    such rows alone ``component_id`` is null and all are ``kept``. Other columns are not read.
    """
    features, _, named = _groups(documents, size, similarity)
    result = features.select("doc_id", "n_shingles", "node").join(named.select("node", "component_id"), on="node", how="left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def one_of_each_group(documents: DataFrame, size: int = 5, similarity: int = 85) -> DataFrame:
    """The rows of ``documents`` without near duplicates: exactly one of each group of linked texts.

    That is the one with the smallest ``doc_id``, null coming last. Of rows of a group that share it, the
    one with the least hash of id and text stays; of those with equal id and text, the one whose columns come first
    in order, so these must have one. What has no word links with nothing, so all such rows stay.
    """
    columns = documents.columns
    _, nodes, named = _groups(documents, size, similarity)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "times").alias("first")
    chosen = nodes.select("node", first).join(named, on="node").groupBy("component").agg(F.min("first").alias("first"))
    chosen = write_scratch(chosen.select(F.col("first.row").alias("__row"), F.col("first.times").alias("__times")), "minhash-chosen")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = documents.where(worded).withColumn("__row", _row())
    once, repeated = (chosen.where(c).select("__row") for c in ("__times = 1", "__times > 1"))
    left = keyed.join(once, on="__row", how="left_semi").select(*columns).unionByName(documents.where(~worded))
    if repeated.isEmpty():
        return left
    rest = keyed.join(repeated, on="__row", how="left_semi").groupBy("__row").agg(F.min(F.struct(*columns)).alias("r"))
    return left.unionByName(rest.select("r.*"))


def _row() -> Column:
    """What tells rows apart where ids are null or repeat."""
    return F.xxhash64("doc_id", "text")


def _groups(documents: DataFrame, size: int, similarity: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The features of each row; ``node, doc_id, row, times`` and more of each set of shingles: its smallest id, the row
    with it and how often that is there; and ``node, component, component_id``."""
    if similarity < LEAST_SIMILARITY:
        raise ValueError("the bands are laid out for a similarity of 80 or more")
    documents = documents.select("doc_id", _row().alias("row"), "text")
    features = write_scratch(_features(documents, size, bands_for(similarity), dict(documents.dtypes)["doc_id"]), "minhash-features")
    full = features.where("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    nodes = full.groupBy("node").agg(first, F.count(F.lit(1)).alias("copies"))
    nodes = nodes.select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.row").alias("row"), "copies")
    one = full.select("node", "row", "n_shingles", "signature", "bands")
    facts = [F.first(c).alias(c) for c in ("doc_id", "row", "copies", "n_shingles", "signature", "bands")]
    nodes = one.join(nodes, on=["node", "row"]).groupBy("node").agg(*facts, F.count(F.lit(1)).alias("times"))
    nodes = write_scratch(nodes, "minhash-nodes")
    rows = nodes.select("node", "copies", F.explode("bands").alias("bucket"))
    pivot = F.max_by("node", F.struct("copies", "node"))
    buckets = rows.groupBy("bucket").agg(pivot.alias("pivot"), F.count(F.lit(1)).alias("members"))
    buckets = write_scratch(buckets.where("members > 1"), "minhash-buckets")
    members = write_scratch(rows.drop("copies").join(buckets, on="bucket"), "minhash-members")
    facts = nodes.select("node", "n_shingles", "signature")
    # The sets of all nodes that share a bucket with another: what any verification may need.
    wanted = write_scratch(nodes.select("node", "row").join(members.select("node").distinct(), on="node"), "minhash-wanted")
    # Here and below the side with texts, sets or signatures is large at any scale worth planning for; Spark would
    # broadcast the other one as long as the input is small.
    sets = _sets(documents.join(wanted.hint("merge"), on="row"), size)
    if not nodes.where("times > 1").isEmpty():  # the very same row is there several times
        sets = sets.dropDuplicates(["node"])
    sets = write_scratch(sets, "minhash-sets")

    stars = members.where("node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    links = _verified(_agreeing_pairs(stars, facts, similarity), sets, similarity)
    groups = write_scratch(connected_components(links), "minhash-groups")

    # Buckets that still hold several components: their pairs across components.
    placed = members.join(groups, on="node", how="left").select(
        "bucket", "members", "node", F.coalesce("component", "node").alias("component")
    )
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y")
    mixed = write_scratch(mixed.select("bucket"), "minhash-mixed")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    blocks = write_scratch(
        placed.join(mixed, on="bucket")
        .withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("bucket", "members", "node", "component", "block", other.alias("other"))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .drop("other"),
        "minhash-blocks",
    )

    def in_order(df: DataFrame) -> DataFrame:
        return df.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    small = in_order(blocks.where(F.col("members") <= SMALL).join(facts, on="node"))
    pairs = small.mapInArrow(tidy(_apart(similarity)), "a long, b long").distinct()
    checked = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = write_scratch(pairs.join(checked, on=["a", "b"], how="left_anti"), "minhash-rest")
    large = blocks.where(F.col("members") > SMALL).join(nodes.select("node", "n_shingles", "signature", "bands"), on="node")
    more = in_order(large.join(sets, on="node")).mapInArrow(tidy(_links_apart(similarity)), "a long, b long")
    more = _verified(pairs, sets, similarity).unionByName(more)
    stars_of = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
    groups = write_scratch(connected_components(stars_of.unionByName(more)), "minhash-all-groups")

    # From nodes back to documents; only the smallest doc_id of each node takes part.
    first = nodes.select("node", "doc_id").join(groups, on="node", how="left")
    first = first.select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    least = write_scratch(first.groupBy("component").agg(F.min("doc_id").alias("component_id")), "minhash-least")
    named = write_scratch(first.join(least, on="component").select("node", "component", "component_id"), "minhash-named")
    return features, nodes, named


def _agreeing_pairs(pairs: DataFrame, facts: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose sizes allow the similarity and whose signatures agree in enough minima."""
    least = least_agreeing(similarity)

    def side(name):
        return facts.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("signature").alias(f"s_{name}"))

    joined = pairs.join(side("a").hint("merge"), on="a").join(side("b").hint("merge"), on="b")
    near = 100 * F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b")

    def agree(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, MINIMA) for c in ("s_a", "s_b")
            )
            enough = (a == b).sum(axis=1) >= least
            yield batch.select(["a", "b"]).filter(pa.array(enough))

    found = joined.where(near).select("a", "b", "s_a", "s_b").mapInArrow(tidy(agree), "a long, b long")
    return write_scratch(found, "minhash-pairs")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs that are similar on their full sets."""
    sets = sets.withColumnRenamed("shingles", "s")
    a = sets.select(F.col("node").alias("a"), F.col("s").alias("s_a"))
    b = sets.select(F.col("node").alias("b"), F.col("s").alias("s_b"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    return write_scratch(
        pairs.join(a.hint("merge"), on="a")
        .join(b.hint("merge"), on="b")
        .where(100 * both >= similarity * (F.size("s_a") + F.size("s_b") - both))
        .select("a", "b")
        .distinct(),
        "minhash-links",
    )
