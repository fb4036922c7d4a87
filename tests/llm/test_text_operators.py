"""Near duplicates, repeated passages, token files and piece encoding against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import ODD_TEXTS, groups, shingle_set, without_repeats, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keytables.llm import minhash_dedup, piece_encoding, substring_dedup, token_files
from keytables.llm.words import join_kept, shingle_hashes, split_words, word_hashes

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_TEXTS, "doc_id long, text string").repartition(3)


def _copies(seed, groups_, of):
    """Texts with edited copies and shared passages."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.choice((20, 60, 150)))] for _ in range(groups_)]
    shared = [rnd.choice(vocabulary) for _ in range(25)]
    rows = []
    for i in range(of):
        text = list(rnd.choice(base))
        for _ in range(rnd.choice((0, 0, 1, 2, 6))):
            text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
        if rnd.random() < 0.3:
            at = rnd.randrange(len(text))
            text[at:at] = shared
        rows.append((i, " ".join(text).upper() if rnd.random() < 0.2 else "\n".join(text)))
    return rows


@settings(deadline=None, max_examples=50)
@given(st.lists(st.text(alphabet=" \t\nab\u00a0é", max_size=20) | st.none(), max_size=8))
def test_words_are_those_of_the_pattern(texts):
    found = split_words(pa.array(texts, pa.string()))
    raw = found.data.tobytes()
    got = [
        [raw[a:b] for a, b in zip(found.start[i:j], found.end[i:j])] for i, j in zip(found.first, found.first[1:])
    ]
    assert got == [words(t) for t in texts]
    kept, ends = join_kept(found, np.ones(len(found.start), bool))
    assert [kept.tobytes()[a:b] for a, b in ends] == [b" ".join(w) for w in got]
    flat = [w for one in got for w in one]
    hashes = word_hashes(found)
    assert len(set(hashes.tolist())) == len(set(flat))
    pairs = shingle_hashes(hashes, 2)
    assert len(set(pairs.tolist())) == len(set(zip(flat, flat[1:])))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed):
    rows = _copies(seed, 12, 240)
    sets = {i: shingle_set(t, 5) for i, t in rows}
    want = groups(sets, 85)
    assert len(set(want.values())) < len(want)
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    for r in got.collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_pairs_apart_in_a_bucket_are_compared(spark, monkeypatch):
    """A chain: neighbours are similar, the ends are not, so no single node of a bucket links them all."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 8)
    text = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join([f"n{j}" for j in range(i)] + text[i:])) for i in range(40)]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in got.collect()} == {0}
    assert set(groups({i: shingle_set(t, 5) for i, t in rows}, 85).values()) == {0}


def test_near_duplicates_of_odd_texts(odd):
    clash = odd.withColumn("node", F.lit(1)).withColumn("kept", F.lit("x"))
    got = minhash_dedup.near_duplicates(clash).collect()
    assert len(got) == len(ODD_TEXTS)
    by = {r.doc_id: r for r in got}
    assert [by[i].n_shingles for i in (1, 2, 3, 4, 8)] == [0, 0, 0, 1, 1]
    assert by[5].component_id == 4 and not by[5].kept and by[4].kept
    assert [by[i].component_id for i in (1, 2, 3, 6, 9)] == [1, 2, 3, 6, 9]
    assert minhash_dedup.near_duplicates(odd.where("false")).collect() == []
    with pytest.raises(ValueError):
        minhash_dedup.near_duplicates(odd, similarity=50)


@pytest.mark.parametrize("seed", [3, 4])
def test_repeats_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(substring_dedup, "STREAM_WORDS", 300)
    rows = [*_copies(seed, 10, 150), (-3, "early " * 40)]
    want = without_repeats(rows, 13)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(table, join_always=True).collect()}
    assert len(got) == len(rows)
    assert sum(len(w) - len(k) for _, w, k in want) > 0
    for i, w, kept in want:
        assert (got[i].n_words, got[i].n_removed) == (len(w), len(w) - len(kept))
        assert got[i].text.encode() == b" ".join(kept)


def test_repeats_of_odd_texts(odd):
    again = odd.union(odd.selectExpr("doc_id + 100", "text")).withColumn("n_words", F.lit("x")).withColumn("extra", F.lit(2))
    got = substring_dedup.remove_repeats(again)
    assert got.columns == ["doc_id", "text", "extra", "n_words", "n_removed"]
    rows = got.collect()
    assert len(rows) == 2 * len(ODD_TEXTS)
    by = {r.doc_id: r for r in rows}
    assert by[1].text is None and by[101].text is None
    assert (by[108].text, by[108].n_removed, by[8].n_removed) == ("", 30_000, 0)
    assert by[106].text == "  one   two\nthree  "
    assert sorted(r.n_removed for r in rows if r.doc_id is None) == [0, 0]
    assert substring_dedup.remove_repeats(odd.where("false")).collect() == []


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 2), max_size=9), max_size=5), st.lists(st.integers(0, 3), max_size=9), st.integers(1, 4))
def test_suffix_automaton(passages, text, window):
    automaton = substring_dedup.SuffixAutomaton()
    for i, p in enumerate(passages):
        automaton.add(p, 10 + i)

    def least(w):
        return next((10 + i for i, p in enumerate(passages) if any(p[k : k + window] == w for k in range(len(p)))), -1)

    want = [least(text[k : k + window]) for k in range(len(text) - window + 1)]
    assert automaton.windows(text, window) == want


ODD_ENDS = ["", None, " a", "a ", "a  b", "a\n b", "it's we'll 'll", "\x1c a \x1c b", "a\x85 b", "\u3000 a \u2009b", "<|endoftext|> b"]


@settings(deadline=None, max_examples=40)
@given(st.lists(st.text(alphabet=" \n\tab'12éß日\u3000\xa0.\x1c", max_size=25), max_size=6))
def test_text_encoder_equals_the_library(texts):
    texts = [*texts, *ODD_ENDS]
    ids, counts = token_files.text_encoder(BYTES).encode(pa.array(texts, pa.string()), 2)
    want = Tokenizer.from_file(BYTES).encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [[*w.ids, 2] for w in want]


def test_a_small_memory_changes_no_ids():
    encoder = token_files.TextEncoder(BYTES, remember=3)
    for texts in (["a b c d e", "f g"], ["a b", None], ["f e d c"]):
        got, _ = encoder.encode(pa.array(texts, pa.string()))
        want, _ = token_files.text_encoder(BYTES).encode(pa.array(texts, pa.string()))
        assert got.tolist() == want.tolist()


def test_token_files_round_trip(spark, tmp_path, odd):
    path = str(tmp_path / "tokens")
    clash = odd.withColumn("part", F.lit("x"))
    token_files.write_token_files(clash, path, BYTES, 2, index_rows=1000)
    files = token_files.read_token_files(spark, path)
    rows = token_files.token_starts(token_files.token_digests(files), files).collect()
    tokenizer = Tokenizer.from_file(BYTES)
    want = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in ODD_TEXTS}
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        options = [want[t] for i, t in ODD_TEXTS if i == r.doc_id]
        crc = zlib.crc32(np.array(options[0], "<u4").tobytes())
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(options[0]), crc)
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert [r.ids for r in token_files.read_token_files(spark, path, [4]).collect()] == [want["one"]]
    plan = token_files.read_token_files(spark, path, [4])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,4)]" in plan or "In(doc_id, [4])" in plan
    empty = str(tmp_path / "none")
    token_files.write_token_files(odd.where("false"), empty, BYTES)
    assert spark.read.schema(files.schema).orc(empty).count() == 0


@settings(deadline=None, max_examples=80)
@given(st.text(alphabet="abcdethionrs \n▁日本é😀12", max_size=60) | st.text(max_size=20))
def test_pieces_equal_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoder = piece_encoding.piece_encoder(PIECES)
    want = library.encode(text, add_eos=True)
    got = np.frombuffer(encoder.encode([text])[0], "<i4").tolist()
    assert got == want
    assert encoder.decode(got) == library.decode(want)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 31_999) | st.integers(3, 258), max_size=12))
def test_decoding_any_ids(ids):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert piece_encoding.piece_encoder(PIECES).decode(ids) == library.decode(ids)


def test_piece_round_trip_of_odd_texts(odd):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoded = piece_encoding.encode_documents(odd.withColumn("ids", F.lit("x")), PIECES)
    back = piece_encoding.decode_documents(encoded, PIECES).collect()
    assert len(back) == len(ODD_TEXTS)
    for r in back:
        assert r.ids == library.encode(r.text or "", add_eos=True)
        assert r.decoded == (r.text or "")
    for r in piece_encoding.round_trip_digests(odd, PIECES).join(odd, "doc_id").collect():
        ids = library.encode(r.text or "", add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert piece_encoding.encode_documents(odd.where("false"), PIECES).count() == 0


def test_a_lower_similarity_finds_more(spark):
    text = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(text)), (1, " ".join(text[:50] + ["x"] + text[51:])), (2, " ".join([*text[:29], "y", *text[30:59], "z", *text[60:]]))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert minhash_dedup.least_agreeing(85) == 88 and minhash_dedup.least_agreeing(80) < 88
    for per_cent in (80, 85, 95):
        want = groups({i: shingle_set(t, 5) for i, t in rows}, per_cent)
        got = minhash_dedup.near_duplicates(table, similarity=per_cent).collect()
        assert {r.doc_id: r.component_id for r in got} == want
    assert groups({i: shingle_set(t, 5) for i, t in rows}, 80) != groups({i: shingle_set(t, 5) for i, t in rows}, 85)


def test_bands_miss_as_few_pairs_at_a_lower_similarity():
    assert (minhash_dedup.bands_for(85), minhash_dedup.bands_for(80), minhash_dedup.bands_for(100)) == (25, 37, 25)
    for similarity in range(80, 101):
        assert (1 - (similarity / 100) ** minhash_dedup.BAND_ROWS) ** minhash_dedup.bands_for(similarity) <= minhash_dedup.MISSED


def test_repeats_of_shared_and_negative_ids(spark):
    """Against a plain search whose units are rows: ids -1, shared smallest ids in several bundles, and null ids."""
    def passage(name, n=30):
        return " ".join(f"{name}{i}" for i in range(n))

    far = " ".join(f"far{i}" for i in range(150_000))  # a bundle of its own
    rows = [
        (-1, passage("minus")),
        (5, passage("minus") + " and more"),
        (0, passage("left") + " " + far),
        (0, passage("common", 12) + " " + passage("right")),
        (0, passage("common", 12) + " " + passage("left2") + " " + passage("right", 20) + " " + far[: len(far) // 2]),
        (3, passage("common", 12) + " " + passage("left2")),
        (4, passage("common", 12) + " " + passage("right")),
        (7, passage("left") + " " + passage("right", 20) + " end"),
        (None, passage("left")),
    ]
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 12):
            if i is not None:
                key = tuple(w[k : k + 13])
                first[key] = min(first.get(key, i), i)
    want = Counter()
    for i, t in rows:
        w = words(t)
        gone = {j for k in range(len(w) - 12) if i is not None and first[tuple(w[k : k + 13])] < i for j in range(k, k + 13)}
        want[i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone)] += 1
    for parts in (1, 3):
        table = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = substring_dedup.remove_repeats(table, join_always=True).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, (r.text or "").encode()) for r in got) == want
