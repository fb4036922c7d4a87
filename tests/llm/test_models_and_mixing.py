"""Quality regression, language identification, URL filters and mixing."""

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD_TEXTS
from pyspark.sql import functions as F

from keytables.llm import language_id, mixing, ordinal_quality, url_filters
from keytables.llm.sampling import drawn

GOOD = "the river runs slowly past green hills and quiet farms where people work".split()
BAD = "buy now cheap pills click here winner free offer".split()


@pytest.fixture(scope="module")
def rated(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(900):
        grade = i % 3
        text = [rnd.choice(GOOD) for _ in range(40)] + [f"n{rnd.randrange(9999)}" for _ in range(8)]
        text += [rnd.choice(BAD) for _ in range((0, 3, 9)[2 - grade])]
        rnd.shuffle(text)
        rows.append((i, " ".join(text), float(grade)))
    return spark.createDataFrame(rows, "doc_id long, text string, rating double")


def test_grades_of_unseen_documents(rated):
    model = ordinal_quality.train(rated, rated.where("doc_id < 600"))
    assert list(model.grades) == [0, 1, 2] and (np.diff(model.thresholds) > 0).all()
    got = ordinal_quality.grade(rated.where("doc_id >= 600"), model).toPandas()
    by = got.groupby("rating")
    assert by.expected_grade.mean().is_monotonic_increasing
    assert by.selected.mean()[2] > 0.95 and by.selected.mean()[0] < 0.02
    assert (abs(by.expected_grade.mean() - [0, 1, 2]) < 0.3).all()
    loose = ordinal_quality.grade(rated, model, least_grade=1).toPandas()
    assert (loose.tail_probability + 1e-12 >= ordinal_quality.grade(rated, model).toPandas().tail_probability).all()


def test_same_model_whatever_the_partitions(rated):
    a, b = (ordinal_quality.train(rated.repartition(n), rated, max_rows=300) for n in (2, 7))
    assert np.allclose(a.weights, b.weights) and np.allclose(a.thresholds, b.thresholds)


def _loss(buckets, counts, y, weights, cuts):
    """The mean negative log-likelihood, document by document."""
    at, total = 0, 0.0
    for n, grade in zip(counts, y):
        score = sum(weights[b] for b in buckets[at : at + n])
        at += n
        above = [1.0, *(1 / (1 + math.exp(c - score)) for c in cuts), 0.0]
        total -= math.log(above[grade] - above[grade + 1])
    return total / len(y)


def test_fit_is_at_the_least_of_the_plain_loss():
    rng = np.random.default_rng(3)
    counts = rng.integers(3, 9, 80)
    buckets = rng.integers(0, 12, counts.sum()) * 1000
    score = np.array([np.sum(x // 1000 % 3 - 1) for x in np.split(buckets, np.cumsum(counts)[:-1])]) + rng.normal(0, 2, 80)
    y = np.digitize(score, [-1, 1.5])
    decay = 0.05
    model = ordinal_quality.fit(buckets, counts, y.astype(float), rounds=2000, decay=decay)
    full = lambda w, c: _loss(buckets, counts, y, w, c) + decay / 2 * (w**2).sum()
    here = full(model.weights, model.thresholds)
    step = 1e-4
    for b in np.flatnonzero(model.weights)[:12]:
        ends = []
        for sign in (1, -1):
            moved = model.weights.copy()
            moved[b] += sign * step
            ends.append(full(moved, model.thresholds))
        assert abs(ends[0] - ends[1]) / (2 * step) < 2e-3 and min(ends) > here - 1e-6
    for k in range(2):
        ends = [full(model.weights, model.thresholds + s * step * (np.arange(2) == k)) for s in (1, -1)]
        assert abs(ends[0] - ends[1]) / (2 * step) < 2e-3


def test_grades_by_the_formula(rated):
    model = ordinal_quality.train(rated, rated.where("doc_id < 300"))
    for r in ordinal_quality.grade(rated.where("doc_id >= 870"), model).collect():
        buckets, _ = ordinal_quality.features(pa.array([r.text]))
        score = sum(float(model.weights[b]) for b in buckets)
        above = [1 / (1 + math.exp(c - score)) for c in model.thresholds]
        assert math.isclose(r.expected_grade, sum(above), rel_tol=1e-4, abs_tol=1e-5)
        assert math.isclose(r.tail_probability, above[-1], rel_tol=1e-4, abs_tol=1e-5)
        assert r.selected == (r.tail_probability >= 0.5)


def test_ratings_of_one_id_on_many_documents(spark, monkeypatch):
    """The pairs of documents and ratings that reach the driver are bounded, not the ratings alone."""
    documents = spark.range(300).selectExpr("1 AS doc_id", "concat('text ', id) AS text")
    ratings = spark.range(50).selectExpr("1 AS doc_id", "CAST(id % 3 AS DOUBLE) AS rating")
    seen = []
    plain = ordinal_quality.fit
    monkeypatch.setattr(ordinal_quality, "fit", lambda b, counts, r, **more: seen.append(len(counts)) or plain(b, counts, r, **more))
    for rows in (documents, spark.range(3000).selectExpr("1 AS doc_id", "'one text' AS text")):
        model = ordinal_quality.train(rows, ratings, max_rows=40)
        assert set(model.grades) <= {0.0, 1.0, 2.0}
    assert max(seen, default=0) <= 80


def test_grading_odd_texts(spark, rated):
    odd = spark.createDataFrame(ODD_TEXTS, "doc_id long, text string").withColumn("selected", F.lit("x"))
    got = ordinal_quality.grade(odd, ordinal_quality.train(rated, rated)).collect()
    assert len(got) == len(ODD_TEXTS) and all(0 <= r.expected_grade <= 2 for r in got)
    none = ordinal_quality.train(odd, rated.where("false"))
    assert all(r.selected and r.expected_grade is None for r in ordinal_quality.grade(odd, none).collect())
    one = ordinal_quality.train(rated, rated.where("rating = 1"))
    assert {(r.expected_grade, r.selected) for r in ordinal_quality.grade(odd, one).collect()} == {(1.0, True)}
    assert ordinal_quality.grade(odd.where("false"), one).collect() == []
    nulls = rated.select("doc_id", F.lit(None).cast("double").alias("rating"))
    assert len(ordinal_quality.train(rated, nulls).grades) == 0


def test_features_do_not_depend_on_neighbours():
    texts = [t for _, t in ODD_TEXTS]
    together, counts = ordinal_quality.features(pa.array(texts, pa.string()))
    alone = [ordinal_quality.features(pa.array([t], pa.string()))[0].tolist() for t in texts]
    assert [x.tolist() for x in np.split(together, np.cumsum(counts)[:-1])] == alone


LANGUAGES = {
    "en": "the of and to in that with for was his are this have from which".split(),
    "de": "der die und in den von zu das mit sich des auf für ist nicht eine".split(),
    "fr": "de la le et les des en un du une que est pour qui dans été".split(),
}


@pytest.fixture(scope="module")
def spoken(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(600):
        lang = rnd.choice(list(LANGUAGES))
        rows.append((i, " ".join(rnd.choice(LANGUAGES[lang]) for _ in range(rnd.choice((5, 20, 200)))), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_unseen_documents(spoken):
    model = language_id.train(spoken.where("doc_id < 400"), max_rows=200)
    assert model.languages == ["de", "en", "fr"]
    got = language_id.identify(spoken.where("doc_id >= 400"), model).toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all() and got.accepted.mean() > 0.8


def test_answers_by_the_formula(spoken):
    model = language_id.train(spoken, max_rows=200)
    for r in language_id.identify(spoken.where("doc_id < 20"), model).collect():
        buckets, _ = language_id.subwords(pa.array([r.text]))
        sums = [sum(float(model.logits[b, k]) for b in buckets) / len(buckets) + model.bias[k] for k in range(3)]
        total = sum(math.exp(x - max(sums)) for x in sums)
        assert r.lang_pred == model.languages[int(np.argmax(sums))] and math.isclose(r.score, 1 / total, rel_tol=1e-3)


def test_languages_of_odd_texts(spark, spoken):
    odd = spark.createDataFrame(ODD_TEXTS + [(20, "123 !?"), (21, "12 é")], "doc_id long, text string")
    odd = odd.withColumn("score", F.lit("x"))
    got = {r.doc_id: r for r in language_id.identify(odd, language_id.train(spoken, 200)).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {1, 2, 3, 20}
    assert not got[1].accepted and got[1].score == 0
    nothing = language_id.train(spoken.where("false"))
    assert {r.lang_pred for r in language_id.identify(odd, nothing).collect()} == {"und"}
    assert language_id.identify(odd.where("false"), nothing).collect() == []
    untold = language_id.train(spoken.withColumn("lang", F.lit(None).cast("string")))
    assert untold.languages == []


URLS = [
    (None, "", ""),
    ("no scheme/x", "", ""),
    ("https://A.Example.ORG/En/1?x#y", "a.example.org", "/En/1"),
    ("x://h", "h", ""),
    ("x://h?q=/p", "h", ""),
    ("x://h#f", "h", ""),
    ("x://É.ORG:80/p/?#", "É.org:80", "/p/"),
    ("x://a://b/c", "a:", "//b/c"),
    ("://", "", ""),
]


def test_host_and_path(spark):
    table = spark.createDataFrame([(u,) for u, *_ in URLS], "url string")
    assert [tuple(r) for r in table.select(*url_filters.host_and_path(F.col("url"))).collect()] == [(h, p) for _, h, p in URLS]


RULES = [
    url_filters.Rule("allow", "org", "/"),
    url_filters.Rule("block", "b.org", "/x"),
    url_filters.Rule("allow", "b.org", "/x/y"),
]


def test_the_longest_rule_wins_and_hosts_decide_the_rest(spark):
    pages = [(i, f"http://{h}/{p}") for i, (h, p) in enumerate([("a.org", ""), ("b.org", "x1"), ("c.b.org", "x/y/z"), ("xb.org", "x"), ("b.org", "")])]
    good = [(100 + i, "http://good.net/p") for i in range(60)] + [(200 + i, "http://bad.net/p") for i in range(60)]
    more = [(300, "http://new.good.net/"), (301, None), (302, "http://org")]
    table = spark.createDataFrame(pages + good + more, "page_id long, url string").withColumn("host", F.lit(1))
    outcomes = spark.createDataFrame([(100 + i, True) for i in range(60)] + [(200 + i, i % 9 == 0) for i in range(60)] + [(300, None)], "page_id long, good boolean")
    rows = url_filters.filter_urls(table, outcomes, RULES).collect()
    assert len(rows) == len(pages + good + more)
    got = {r.page_id: r for r in rows}
    assert [got[i].rule for i in range(5)] == ["org/", "b.org/x", "b.org/x/y", "org/", "org/"]
    assert [got[i].verdict for i in range(5)] == ["allow", "block", "allow", "allow", "allow"]
    assert got[100].verdict == "allow" and got[200].verdict == "block" and got[302].rule is None
    assert got[100].reputation > got[300].reputation > got[200].reputation
    assert (got[301].host, got[301].path) == ("", "")
    none = url_filters.filter_urls(table, outcomes.where("false"), RULES).collect()
    assert {r.reputation for r in none} == {0.5}
    assert url_filters.filter_urls(table.where("false"), outcomes, RULES).collect() == []


SUFFIXES = ["co.uk", "com.au", "github.io", "a.very.long.uk", "uk.com"]


def _plain_domain(host):
    labels = host.split(".")
    end = max((x for x in SUFFIXES if host == x or host.endswith(f".{x}")), key=len, default=labels[-1])
    return ".".join(labels[-end.count(".") - 2 :]), end


def test_suffixes_of_several_labels(spark):
    hosts = ["bbc.co.uk", "www.bbc.co.uk", "co.uk", "uk", "x.uk", "notco.uk", "me.github.io", "b.me.github.io", "github.io", ""]
    hosts += ["a.very.long.uk", "z.a.very.long.uk", "y.z.a.very.long.uk", "very.long.uk", "shop.uk.com", "x.com.au", "com.au.org"]
    table = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = table.select("host", url_filters.registered_domain(F.col("host"), SUFFIXES), url_filters.suffix(F.col("host"), SUFFIXES))
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == {h: _plain_domain(h) for h in hosts}
    plain = table.select("host", url_filters.registered_domain(F.col("host")), url_filters.suffix(F.col("host")))
    assert all((r[1], r[2]) == (".".join(r[0].split(".")[-2:]), r[0].split(".")[-1]) for r in plain.collect())
    for wrong in ("uk", "Co.uk", ".co.uk", ""):
        with pytest.raises(ValueError):
            url_filters.suffix(F.col("host"), [wrong])


def test_sites_under_one_suffix_do_not_share_a_reputation(spark):
    urls = [f"http://p{i % 3}.good.co.uk/{i}" for i in range(90)] + [f"http://p{i % 3}.bad.co.uk/{i}" for i in range(90)]
    urls += ["http://new.good.co.uk/", "http://new.bad.co.uk/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    outcomes = spark.createDataFrame([(i, i < 90 or i % 10 == 0) for i in range(180)], "page_id long, good boolean")
    with_list = {r.page_id: r for r in url_filters.filter_urls(pages, outcomes, [], suffixes=SUFFIXES).collect()}
    without = {r.page_id: r for r in url_filters.filter_urls(pages, outcomes, []).collect()}
    assert with_list[180].reputation > with_list[181].reputation + 0.3
    assert math.isclose(without[180].reputation, without[181].reputation)
    assert (with_list[180].verdict, with_list[181].verdict) == ("allow", "block")


def test_poisson_counts(spark):
    table = spark.range(4000).selectExpr("id AS doc_id", "IF(id % 4 = 0, 'a', IF(id % 4 = 1, NULL, 'b')) AS source", "1 AS copy")
    got = mixing.mix_sources(table, "source", {"a": 2.5, "b": 0.5})
    rows = got.collect()
    assert [r.shuffle_key for r in rows] == sorted(r.shuffle_key for r in rows)
    assert {r.source for r in rows} == {"a", "b"}
    counts = got.groupBy("source", "doc_id").count().groupBy("source").agg(F.sum("count").alias("n"), F.sum(F.col("count") ** 2).alias("s")).collect()
    for r in counts:
        n, rate = (1000, 2.5) if r.source == "a" else (2000, 0.5)
        assert abs(r.n / n - rate) < 4 * math.sqrt(rate / n)
        assert abs(r.s / n - rate - rate * rate) < 0.15 * (rate + rate * rate)
    again = mixing.mix_sources(table.repartition(9), "source", {"b": 0.5, "a": 2.5})
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in rows]


def test_rates_reach_the_weights(spark):
    table = spark.createDataFrame([("a", 10), ("a", 30), ("b", 60), ("c", None), (None, 5)], "source string, n long")
    rates = mixing.repetition_rates(table, "source", {"a": 3, "b": 1, "c": 1, "d": 1}, size=F.col("n"))
    assert set(rates) == {"a", "b"}
    assert math.isclose(rates["a"] * 40, 75) and math.isclose(rates["b"] * 60, 25)
    assert mixing.repetition_rates(table.where("false"), "source", {"a": 1}) == {}
    odd = mixing.mix_sources(spark.createDataFrame(ODD_TEXTS * 50, "doc_id long, text string"), "text", {}, default_rate=1)
    n = len(ODD_TEXTS) * 50
    assert abs(odd.count() - n) < 5 * n**0.5 and odd.columns == ["doc_id", "text", "copy", "shuffle_key"]
    assert mixing.mix_sources(table.where("false"), "source", {"a": 1}, key="n").collect() == []


def test_steps_are_those_of_the_distribution():
    steps = mixing.poisson_steps(1.5)
    want = [sum(math.exp(-1.5) * 1.5**j / math.factorial(j) for j in range(k + 1)) for k in range(len(steps))]
    assert np.allclose(steps, want, rtol=1e-13) and 1 - steps[-1] < 1e-12


@pytest.mark.parametrize("rate", [0.01, 1, 50, 720, 1000, 20_000.5])
def test_steps_of_large_rates(rate):
    steps = mixing.poisson_steps(rate)
    terms = [math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1)) for k in range(len(steps) + 1)]
    assert np.allclose(steps, np.cumsum(terms)[:-1], rtol=0, atol=1e-9)
    assert steps == sorted(steps) and steps[-1] <= 1 - 2.0**-48 < steps[-1] + 2 * terms[-1] + 2.0**-48
    # The mean is the sum of P(X > k).
    assert math.isclose(math.fsum(1 - s for s in steps), rate, rel_tol=1e-9)


def test_steps_are_exact_to_the_last_digits():
    r = Fraction(50)
    terms = [Fraction(1)]
    for k in range(1, 400):
        terms.append(terms[-1] * r / k)
    total = sum(terms)
    at, want = Fraction(0), []
    for t in terms:
        at += t
        want.append(float(at / total))
    steps = mixing.poisson_steps(50.0)
    assert np.allclose(steps, want[: len(steps)], rtol=0, atol=2.0**-49 + 2e-16)


@pytest.mark.parametrize("rate", [50.0, 720.0, 1000.0])
def test_copies_at_large_rates(spark, rate):
    table = spark.range(300).selectExpr("id AS doc_id", "'a' AS source")
    counts = Counter(r.doc_id for r in mixing.mix_sources(table, "source", {"a": rate}).select("doc_id").collect())
    n = np.array([counts[i] for i in range(300)])
    assert abs(n.mean() - rate) < 5 * math.sqrt(rate / 300)
    assert 0.6 * rate < n.var() < 1.6 * rate


def test_samples_of_very_large_tables_are_not_empty(spark):
    """Part of a table said to have more than 2**20 times the rows wanted."""
    total = 1000 * 2**22
    assert (1000 << 20) // total == 0
    found = spark.range(2**27).where(drawn(1000, total, "id", F.lit("x"))).count()
    assert abs(found - 32) < 5 * 32**0.5
    small = spark.range(20_000)
    assert abs(small.where(drawn(1000, 20_000, "id")).count() - 1000) < 160
    assert small.where(drawn(20_000, 20_000, "id")).count() == 20_000
