"""Golden and property tests on hand-written rows that the driver tables don't have."""

import json
import random
import tracemalloc
import unicodedata
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.config import MAX_LENGTH, RAW_COLUMNS, REQUIRED, TASKS
from tessera.functions import arrays, text
from tessera.operators import clean, encode, metrics, model, predict, profile, ranking, split, tokens, train, validate
from tessera.sources import tables
from tessera.streaming import score as streaming

RAW = """Judul,Content,source,tag1,tag2,tag3,tag4,tag5,Link,Waktu
a,"body ""one"",
second line",s1,t,,,,,http://x/1,now
a,"body ""one"",
second line",s1,t,,,,,http://x/1,now
a,"body ""one"",
second line",s1,t,,,,,http://x/2,now
NA,body two,s2,null,nan,,,,http://x/3,now
b,,s2,,,,,,http://x/4,now
c,body three,N/A,,,,,,http://x/5,now
"""


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "raw.csv"
    path.write_text(RAW)
    return tables.read_csv(spark, str(path), RAW_COLUMNS)


def test_csv_scan(raw):
    rows = raw.orderBy("ord").collect()
    assert len(rows) == 6 and rows[0].Content == 'body "one",\nsecond line'
    assert rows[3].Judul is None and rows[3].tag1 is None and rows[4].Content is None and rows[5].source is None
    assert [r.ord for r in rows] == sorted(r.ord for r in rows)


def test_missing_path(spark):
    with pytest.raises(PySparkException):
        tables.read_csv(spark, "/nowhere/at/all.csv", RAW_COLUMNS).count()


def test_raw_pipeline(raw):
    out = clean.clean_raw(raw).orderBy("ord").collect()
    # equal texts with different links survive, null titles and tags stay, null content goes
    assert [r.Judul for r in out] == ["a", "a", None, "c"] and "Link" not in out[0]
    assert profile.duplicate_count(raw.drop("ord")).first()[0] == 1
    assert {r["column"]: r.n_missing for r in profile.missing(raw).collect()}["Judul"] == 1
    assert [r.value for r in profile.distinct_first_seen(raw, "Judul", "ord").orderBy("first_seen").collect()] == ["a", None, "b", "c"]
    assert profile.duplicate_rows(raw, ["Judul"], "ord").count() == 2
    with pytest.raises(ValueError):
        clean.drop_columns(raw, ["no such"])


def python_clean(s):
    import re

    s = unicodedata.normalize("NFKC", s or "")
    s = re.sub(r"(?:https?://|www\.)\S+", " ", s)
    return " ".join(s.split())


def test_clean_text(spark):
    rng = random.Random(1)
    parts = ["ﬁn", "Ａ", " ", "　", "\x1c", "\x85", " ", "http://a.b/c", "https://x", "www.", "www.q", "WWW.x", " ", "\n", "\t", "🙂", "word", "é", "é", "​"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(1500)] + [None, "", " \n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    once = df.withColumn("c", text.clean_text(F.col("t")))
    got = {r.i: (r.c, r.d) for r in once.withColumn("d", text.clean_text(F.col("c"))).collect()}
    for i, t in enumerate(texts):
        assert got[i][0] == python_clean(t) and got[i][1] == got[i][0], repr(t)


def labelled(spark, rows):
    return spark.createDataFrame(rows, "article_id string, title string, content_clean string, " + ", ".join(f"{t} string" for t in TASKS))


def test_labelled_pipeline(spark):
    good = ("no", "yes", "uncertain", "A")
    df = labelled(spark, [("1", " t x ", "c", " no ", "yes", "uncertain　", "C"), ("2", "http://x.y", "c", None, "odd", "no", "A"), ("3", "t", None, *good), ("4", "t", "c", *good)])
    out = clean.clean_labelled(df).orderBy("article_id").collect()
    assert [r.article_id for r in out] == ["1", "4"]
    assert [out[0][f"{t}_id"] for t in TASKS] == [0, 1, 2, 2] and out[0].title == "t x"
    for bad in (None, "odd"):
        with pytest.raises(PySparkException):
            clean.clean_labelled(labelled(spark, [("1", "t", "c", bad, "yes", "no", "A")])).collect()


def test_validation(spark):
    df = labelled(spark, [("1", "t", "c", " no ", "yes", "no", "A"), ("1", "t", "c", "maybe", None, "no", "D")])
    assert validate.repeated_keys(df, "article_id").collect()[0].n == 2
    assert {(r.task, r.label) for r in validate.unknown_labels(df, TASKS).collect()} == {("clickbait_framing_label", "maybe"), ("market_relevance_label", "D")}
    assert validate.missing_columns(df, REQUIRED) == {"source", "published_at", "rationale", "annotator_id", "annotation_status"}
    with pytest.raises(ValueError, match="repeated"):
        validate.validate(df, df.columns, "article_id", TASKS)
    with_ids = encode.encode(df, TASKS, strict=False)
    assert not validate.leaked_columns(clean.features_only(with_ids))
    s = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "a")], "k int, split string")
    assert [r.k for r in validate.shared_keys(s, "k").collect()] == [1]


def test_encoding(spark):
    df = spark.createDataFrame([("no",), ("yes",), ("yes",), ("yes",)], "x string")
    w = {r.label: r.weight for r in encode.class_weights(df, {"x": ["no", "yes", "uncertain"]}).collect()}
    assert w == {"no": 4 / 3, "yes": 4 / 9, "uncertain": 4 / 3}
    hot = encode.one_hot_arrays(encode.encode(df, {"x": ["no", "yes", "uncertain"]}), {"x": ["no", "yes", "uncertain"]})
    assert sorted(r.x_hot for r in hot.collect())[-1] == [1, 0, 0]
    maps = encode.mappings(TASKS)
    assert all(maps["id2label"][t][maps["label2id"][t][c]] == c for t, cs in TASKS.items() for c in cs)


def test_histogram_edges(spark):
    one = spark.createDataFrame([(5.0,)] * 3, "x double")
    assert sum(r.n for r in profile.histogram(one, F.col("x")).collect()) == 3
    many = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    got = [r.n for r in profile.histogram(many, F.col("x")).orderBy("bin").collect()]
    assert got == np.histogram(np.arange(101.0), bins=10)[0].tolist()
    assert profile.histogram(one.limit(0), F.col("x")).count() == 0
    around = profile.around_mean(many, F.col("x")).first()
    assert around.n_above == around.n_below == 50


def test_split(spark):
    rng = random.Random(2)
    rows = [(i, *(rng.choices((0, 1, 2), (90, 8, 2))[0] for _ in range(4))) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, a int, b int, c int, d int")
    names = ["a", "b", "c", "d"]
    out = split.stratified_split(df, "k", names)
    got = {r.k: r.split for r in out.collect()}
    assert set(got) == {r[0] for r in rows} and got == {r.k: r.split for r in split.stratified_split(df.repartition(3), "k", names).collect()}
    share = {"train": 0.8, "val": 0.1, "test": 0.1}
    for place in range(1, 5):
        for label in (0, 1, 2):
            all_ = [r for r in rows if r[place] == label]
            for s, f in share.items():
                assert abs(sum(got[r[0]] == s for r in all_) - f * len(all_)) <= 3
    assert validate.shared_keys(out, "k").count() == 0
    assert split.stratified_split(df.limit(0), "k", names).count() == 0


def test_ranks(spark):
    df = spark.createDataFrame([(i * 7 % 1000, "g" if i % 3 else None) for i in range(1000)], "k long, g string").repartition(5)
    assert all(r.k == r.rank for r in ranking.key_rank(df, "k").collect())
    by = {}
    for r in ranking.hash_rank(df, ["g"], "k", 1).collect():
        by.setdefault(r.g, []).append(r.rank)
    assert all(sorted(x) == list(range(len(x))) for x in by.values()) and len(by) == 2


def test_ranks_in_many_buckets(spark):
    """Buckets follow from the number of rows; keys crowd between two quantiles, lie below zero, beyond 2 ** 53 and are null."""
    keys = [None, -(2**60), 2**60, 2**60 + 1] + [-(i**3) for i in range(1, 2000)] + list(range(5000)) + [10**9 + i for i in range(3)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    got = {r.k: r.rank for r in ranking.key_rank(df, "k", rows=4).collect()}
    assert got == {k: i for i, k in enumerate([None, *sorted(keys[1:])])}
    assert df.select(ranking.range_bucket(df, "k", 4)).distinct().count() > 3 * ranking.RANGES
    rows = ranking.hash_rank(df, [], "k", 1, rows=4).withColumn("h", F.xxhash64("k", F.lit(1))).orderBy("h").collect()
    assert [r["rank"] for r in rows] == list(range(len(keys)))
    sums = ranking.numbered_sums(df.where("k is not null").withColumn("n", F.lit(2)), "k", "n", "end", rows=4).orderBy("k").collect()
    assert [r.end for r in sums] == list(range(2, 2 * len(keys), 2))


def test_tokens(spark):
    df = spark.createDataFrame([(1, "a b", "c " * 500), (2, "t " * 400, "c"), (3, None, "x y"), (4, "", None)], "k long, title string, content string")
    out = {r.k: r for r in tokens.encode_pair(df, "title", "content").collect()}
    assert out[1].n_tokens == MAX_LENGTH and len(out[1].content_tokens) == MAX_LENGTH - 3 - 2
    assert out[2].over_budget and out[2].content_tokens == [] and len(out[2].title_tokens) == 400
    assert out[3].title_tokens == [] and out[4].n_tokens == 3
    many = spark.range(20).select(F.col("id").alias("k"), F.array_repeat(F.lit("w"), F.col("id").cast("int")).alias("t"))
    rows = tokens.padded(tokens.batched(many, "k", 8), "t").collect()
    assert {r.batch for r in rows} == {0, 1, 2} and all(len(r.t) == len(r.mask) for r in rows)
    assert {r.batch: len(r.t) for r in rows} == {0: 7, 1: 15, 2: 19} and all(sum(r.mask) == r.k for r in rows)
    shuffled = tokens.batched(many, "k", 8, shuffle=True).groupBy("batch").count().collect()
    assert sorted(r["count"] for r in shuffled) == [4, 8, 8]


def test_scores(spark):
    df = spark.createDataFrame([([1.0, 1.0, 0.0],), ([1000.0, 0.0, -1000.0],), ([0.0, 0.0, 0.0],)], "z array<double>")
    rows = df.select(arrays.softmax(F.col("z")).alias("p"), arrays.argmax(F.col("z")).alias("k")).collect()
    assert [r.k for r in rows] == [0, 0, 0] and all(abs(sum(r.p) - 1) < 1e-12 for r in rows) and rows[1].p[0] == 1.0


def test_loss_and_schedule(spark):
    rows = [(i, i % 3, [0.2, 0.3, 0.5]) for i in range(10)]
    df = spark.createDataFrame(rows, "k long, t_id int, t_probs array<double>")
    w, p = np.array([1.0, 2.0, 0.5]), np.array([0.2, 0.3, 0.5])
    y = np.arange(10) % 3
    assert abs(model.losses(df, {"t": w}).first().loss - (-np.log(p[y]) * w[y]).sum() / w[y].sum()) < 1e-12
    means = [(-np.log(p[b]) * w[b]).sum() / w[b].sum() for b in (y[:8], y[8:])]
    assert abs(model.batch_mean_loss(tokens.batched(df, "k", 8), {"t": w}).first()[0] - np.mean(means)) < 1e-12
    assert model.updates(600) == (750, 75) and model.updates(1) == (5, 0)
    factors = [r.factor for r in model.schedule(spark, 20, 4).orderBy("step").collect()]
    assert factors == [u / 4 if u < 4 else max(0.0, (20 - u) / 16) for u in range(21)]


def test_history(spark):
    h = spark.createDataFrame([(1, 0.5), (2, 0.5), (3, 0.6), (4, 0.6), (5, 0.6), (6, 0.9)], "epoch int, mean_macro_f1 double")
    best = model.best_epoch(h).first()
    assert (best.best_epoch, best.best_score, best.last_epoch) == (3, 0.6, 5)


def python_metrics(y, p, k):
    f1 = []
    for c in range(k):
        hit = sum(a == b == c for a, b in zip(y, p, strict=True))
        f1.append(2 * hit / (y.count(c) + p.count(c)) if y.count(c) + p.count(c) else 0.0)
    return f1


@pytest.mark.parametrize("case", ["perfect", "one class", "mixed", "absent"])
def test_metrics(spark, case):
    rng = random.Random(3)
    y = [rng.randrange(2 if case == "absent" else 3) for _ in range(60)]
    p = {"perfect": y, "one class": [1] * 60}.get(case) or [rng.randrange(2 if case == "absent" else 3) for _ in y]
    yp = spark.createDataFrame([("t", a, b) for a, b in zip(y, p, strict=True)], "task string, y int, p int")
    classes = {"t": ["no", "yes", "uncertain"]}
    f1 = python_metrics(y, p, 3)
    c = metrics.per_class(yp, classes)
    assert [r.f1 for r in c.orderBy("k").collect()] == pytest.approx(f1)
    assert metrics.macro_fixed(c).first().macro_f1 == pytest.approx(np.mean(f1))
    seen = [k for k in range(3) if k in y or k in p]
    assert metrics.macro_f1_observed(c).first().macro_f1 == pytest.approx(np.mean([f1[k] for k in seen]))
    assert metrics.weighted_f1(c).first().weighted_f1 == pytest.approx(sum(f1[k] * y.count(k) for k in range(3)) / 60)
    cm = metrics.confusion_matrix(yp, classes)
    assert cm.count() == 9 and cm.agg(F.sum("n")).first()[0] == 60
    assert metrics.wide_confusion(cm, 3).count() == 3 and metrics.report(yp, classes).count() == 6


def test_training_and_prediction(spark, tmp_path):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(3, 8)) * 3
    rows = [(i, [float(v) for v in centers[i % 3] + rng.normal(size=8)], i % 3, ["no", "yes", "uncertain"][i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, x array<double>, t_id long, t string")
    heads = model.train_heads(df, "x", {"t": ["no", "yes", "uncertain"]})
    tables_path = str(tmp_path / "heads")
    model.head_rows(spark, heads).write.parquet(tables_path)
    heads = model.heads_of(spark.read.parquet(tables_path))
    assert heads["t"].size == 27
    scored = model.score(df, "x", heads)
    assert metrics.accuracy(metrics.pairs(scored, ["t"])).first().accuracy > 0.95
    wide = {"t": model.Head(["no", "yes"], [[0.1] * 64, [-0.1] * 64], [0.0, 0.0])}
    got = predict.predict_article(spark, "Tit le", "see http://x.y now", wide)
    assert got["t"]["label"] == "no" and sum(got["t"]["probabilities"].values()) == pytest.approx(1)
    articles = spark.createDataFrame([("a", "b c"), (None, None)], "title string, content string")
    out = predict.predict(articles, wide).select(predict.as_json().alias("j")).collect()
    assert all(set(json.loads(r.j)["t"]) == {"label", "confidence", "probabilities"} for r in out)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\nc', "train"), (2, None, "test")], "k int, t string, split string")
    tables.write_splits(df, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).where("split = 'test'").count() == 1
    tables.write_csv(df, str(tmp_path / "c"))
    back = tables.read_csv(spark, str(tmp_path / "c"), df.columns, order=None).orderBy("k").collect()
    assert back[0].t == 'a "b"\nc' and back[1].t is None
    record = {"label2id": {"t": {"Überschrift": 0}}}
    tables.write_json(spark, record, str(tmp_path / "j"))
    assert tables.read_json(spark, str(tmp_path / "j")) == record
    tables.append(df, str(tmp_path / "h"))
    tables.append(df, str(tmp_path / "h"))
    assert tables.read_table(spark, str(tmp_path / "h")).count() == 4


def test_streaming(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a", "b"), ("c", "d")], "title string, content string").write.parquet(source)
    stream = spark.readStream.schema("title string, content string").parquet(source)
    heads = {"t": model.Head(["no", "yes"], [[0.1] * 64, [-0.1] * 64], [0.0, 0.0])}
    q = streaming.to_parquet(streaming.predict_stream(stream, heads), out, str(tmp_path / "check"))
    assert q.awaitTermination(120) and spark.read.parquet(out).count() == 2
    timed = spark.read.parquet(out).withColumn("ts", F.timestamp_seconds(F.lit(600)))
    assert [r.n for r in streaming.label_rates(timed, "t", "ts").collect()] == [2]


# --- the epoch loop


def blobs(spark, n=400):
    rng = random.Random(31)
    rows = []
    for i in range(n):
        a, b = rng.randrange(3), rng.randrange(2)
        x = [rng.gauss(2.0 * (a == k), 0.5) for k in range(3)] + [rng.gauss(3.0 * b, 0.5)]
        rows.append((i, x, "nyu"[a], "AB"[b], a, b))
    return spark.createDataFrame(rows, "k long, x array<double>, one string, two string, one_id long, two_id long").repartition(3)


BLOB_TASKS = {"one": ["n", "y", "u"], "two": ["A", "B"]}


def test_gradient_matches_a_numeric_one(spark):
    rows = blobs(spark, 60).cache()
    w = np.random.default_rng(32).normal(size=3 * 5 + 2 * 5)
    weights = {"one": [1.0, 2.0, 0.5], "two": [1.0, 3.0]}
    args = (rows, "k", "x", BLOB_TASKS, weights)
    g, loss = train.gradient(*args, w, 4, 0.0, 1)
    want = model.losses(model.score(rows, "x", train.unflat(w, BLOB_TASKS, 4)), weights).first()
    assert loss == pytest.approx(want.loss)
    for i in (0, 4, 7, 16, 24):
        up = w.copy()
        up[i] += 1e-5
        assert (train.gradient(*args, up, 4, 0.0, 1)[1] - loss) / 1e-5 == pytest.approx(g[i], abs=1e-3)
    assert (train.flat(train.unflat(w, BLOB_TASKS, 4)) == w).all()
    dropped = train.gradient(*args, w, 4, 0.5, 1)
    assert dropped[1] == train.gradient(*args, w, 4, 0.5, 1)[1] != train.gradient(*args, w, 4, 0.5, 2)[1]


def test_epochs_checkpoint_and_reload(spark, tmp_path):
    rows = blobs(spark).cache()
    settings = train.Settings(epochs=4, updates=6, accumulation=2, rate=0.2, patience=1)
    heads, history = train.fit(rows.where("k % 5 > 0"), rows.where("k % 5 = 0"), "k", "x", BLOB_TASKS, str(tmp_path), settings)
    assert 1 <= len(history) <= 4 and history[0]["train_loss"] > history[-1]["train_loss"]
    best = max(h["mean_macro_f1"] for h in history)
    record = tables.read_json(spark, f"{tmp_path}/best_metadata")
    assert record["best_val_macro_f1"] == best > 0.9 and record["epoch"] == next(h["epoch"] for h in history if h["mean_macro_f1"] == best)
    _, f1, yp = train.evaluate(rows.where("k % 5 = 0"), "x", "k", heads, {"one": [1, 1, 1], "two": [1, 1]})
    assert np.mean([r.macro_f1 for r in f1.collect()]) == pytest.approx(best) and yp.count() == 160
    stored = spark.read.parquet(f"{tmp_path}/history").orderBy("epoch").collect()
    assert [r.epoch for r in stored] == [h["epoch"] for h in history] and stored[0].val_loss == history[0]["val_loss"]
    assert tables.read_json(spark, f"{tmp_path}/production")["selection_metric"] == "mean_validation_macro_f1"
    with pytest.raises(ValueError):
        train.fit(rows.limit(0), rows, "k", "x", BLOB_TASKS, str(tmp_path / "none"))


def test_optimizer_steps():
    s = train.Settings(decay=0.1)
    adam = train.AdamW(2, s)
    w = adam.update(np.array([1.0, -2.0]), np.array([3.0, 0.0]), 0.01)
    assert w == pytest.approx([1 * (1 - 0.001) - 0.01, -2 * (1 - 0.001)])
    assert np.linalg.norm(train.clipped(np.array([3.0, 4.0]), 1.0)) == pytest.approx(1, abs=1e-6) and (train.clipped(np.array([0.3, 0.4]), 1.0) == [0.3, 0.4]).all()
    assert [train.factor(k, 10, 2) for k in (0, 1, 2, 10)] == [0, 0.5, 1, 0]


# --- percentiles, subwords, vocabulary


def test_percentiles_against_numpy(spark):
    rng = random.Random(33)
    for values in ([5.0], [1.0, 1.0, 1.0], [rng.choice((rng.gauss(0, 1), 7.0)) for _ in range(999)], [None, 3.0, 1.0]):
        got = profile.describe(spark.createDataFrame([(v,) for v in values], "v double").repartition(3), "v", (0.0, 0.1, 0.5, 0.99, 1.0)).first()
        known = [v for v in values if v is not None]
        assert [got.p0, got.p10, got.p50, got.p99, got.p100] == pytest.approx(np.percentile(known, [0, 10, 50, 99, 100]))
    assert profile.describe(spark.createDataFrame([(None,)], "v double"), "v").first().p50 is None


def test_subword_pairs_keep_titles_whole(spark):
    pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows = [(1, "A short title", "words and words " * 300), (2, None, "unbelievable"), (3, "long title " * 300, "gone")]
    df = spark.createDataFrame(rows, "id long, title string, content string")
    for r in tokens.encode_pair(df, "title", "content", 384, tokenize=tokens.subwords()).collect():
        a, b = (t.encode(x or "", add_special_tokens=False).tokens for x in (r.title, r.content))
        assert r.title_tokens == a and r.content_tokens == b[: max(0, 381 - len(a))] and r.over_budget == (len(a) > 381)


def test_vocabulary_sink(spark, tmp_path):
    df = spark.createDataFrame([(["a", "b", "a"],), ([],), (["b"],)], "tokens array<string>")
    tables.write_vocabulary(df, f"{tmp_path}/vocabulary")
    assert {r.token: r.n for r in spark.read.parquet(f"{tmp_path}/vocabulary").collect()} == {"a": 2, "b": 2}


# --- what reaches Python


def python_steps(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("EvalPython")


def test_words_of_a_prediction_stay_out_of_python(spark):
    rng = random.Random(7)
    rows = [(i, [rng.choice(["a", "", "é", "ﬁ", "🙂", str(rng.random())]) for _ in range(n)]) for i, n in enumerate([0, 1, 2, 63, 64, 65, 3000])] + [(99, None)]
    df = spark.createDataFrame(rows, "i int, t array<string>")
    for size in (1, 7, 64):
        out = df.select("i", predict.hashed_features(F.col("t"), size).alias("x"))
        got = {r.i: r.x for r in out.collect()}
        for i, ws in rows:
            want = np.bincount([crc32(w.encode()) % size for w in ws or []], minlength=size) / max(len(ws or []), 1)
            assert got[i] == want.tolist()
        assert python_steps(out) == 0
    heads = {"t": model.Head(["no", "yes"], [[0.1] * 64, [-0.1] * 64], [0.0, 0.0])}
    articles = spark.createDataFrame([("a", "b c")], "title string, content string")
    assert python_steps(predict.predict(articles, heads)) == 1 and python_steps(predict.predict(articles, heads, normalize=False)) == 0


def test_normalisation_holds_few_texts(spark, monkeypatch):
    made, real = [], F.arrow_udf

    def keep(kind):
        return lambda f: made.append(f) or real(kind)(f)

    monkeypatch.setattr(F, "arrow_udf", keep)
    text.nfkc(F.col("t"))
    texts = pa.array([None if i % 3 == 0 else f"{i} ﬁ " + "é" * 10000 for i in range(3000)])
    tracemalloc.start()
    try:
        out = made[0](texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # all 2000 would take 80 MB, as much again when normalised
    assert peak < 8e6
    assert out.to_pylist() == [x if x is None else unicodedata.normalize("NFKC", x) for x in texts.to_pylist()]
    assert made[0](texts.slice(0, 0)).to_pylist() == [] and made[0](texts.slice(0, 1)).to_pylist() == [None]


def test_ascii_texts_do_not_travel(spark):
    seen = spark.sparkContext.accumulator(0)
    texts = [None, "", "plain", "ﬁn", "가", "Å b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    real = F.arrow_udf

    def counted(kind):
        def wrap(f):
            def g(s: pa.Array) -> pa.Array:
                seen.add(len(s) - s.null_count)
                return f(s)

            return real(kind)(g)

        return wrap

    with pytest.MonkeyPatch.context() as m:
        m.setattr(F, "arrow_udf", counted)
        run = df.withColumn("n", text.nfkc(F.col("t")))
    assert {r.i: r.n for r in run.collect()} == {i: t and unicodedata.normalize("NFKC", t) for i, t in enumerate(texts)}
    assert seen.value == 3
