import math
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from ragtables.functions.draws import distinct_draws, keyed_uniform
from ragtables.operators import sampling


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 7, f"k{i}", [f"p{i}", f"r{i}"], i * 1.5) for i in range(60)]
    return spark.createDataFrame(
        rows, "id long, name string, passages array<string>, x double"
    ).repartition(5)


def collected(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def same_for_any_partitioning(spark, make):
    """The result with 1 and with 7 shuffle partitions."""
    setting = "spark.sql.shuffle.partitions"
    before, found = spark.conf.get(setting), []
    try:
        for count in ("1", "7"):
            spark.conf.set(setting, count)
            found.append(collected(make()))
    finally:
        spark.conf.set(setting, before)
    assert found[0] == found[1]
    return found[0]


def test_row_index_is_dense_in_either_order(spark, docs):
    for key in ("id", "name"):
        rows = sampling.row_index(docs, key, 3).collect()
        assert sorted(r.idx for r in rows) == list(range(60))
    rows = sampling.row_index(docs, "id", order="key").orderBy("id").collect()
    assert [r.idx for r in rows] == list(range(60))
    rows = sampling.row_index(docs, "x", order="key").orderBy("x").collect()
    assert [r.idx for r in rows] == list(range(60))
    rows = sampling.row_index(docs, "name", order="key").orderBy("name").collect()
    assert [r.idx for r in rows] == list(range(60))
    assert rows[0].asDict().keys() == {"id", "name", "passages", "x", "idx"}
    with pytest.raises(ValueError):
        sampling.row_index(docs, "id", order="other")
    same_for_any_partitioning(spark, lambda: sampling.row_index(docs, "id", 3))


NUMBERED_FIRST = """
import sys, tempfile
from pyspark.sql import functions as F
from session import local_session
from ragtables.operators import sampling
spark = local_session("2")
path = tempfile.mkdtemp() + "/table"
spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a").alias("t")).write.parquet(path)
names = spark.read.parquet(path).select("doc_id", F.col("doc_id").cast("string").alias("name"), "t")
rows = sampling.row_index(names.select("name"), "name", order="key").collect()
rows.sort(key=lambda r: r.idx)
assert [r.name for r in rows] == sorted(str(i) for i in range(40)), rows
"""


def test_numbers_by_key_as_the_first_query_of_a_session():
    """The optimizer's numbers of columns, small in a new session, must not matter."""
    paths = [os.path.dirname(__file__), os.path.dirname(os.path.dirname(__file__))]
    run = subprocess.run(
        [sys.executable, "-c", NUMBERED_FIRST],
        env=os.environ | {"PYTHONPATH": os.pathsep.join(paths)},
        capture_output=True,
        text=True,
        timeout=120,
    )
    assert run.returncode == 0, run.stderr[-3000:]


def test_row_index_of_a_clustered_key(spark):
    # Nearly all keys close together, a few far away.
    keys = list(range(3000)) + [10**15, -(10**15), 10**17]
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    rows = sampling.row_index(df, "id", order="key").orderBy("id").collect()
    assert [r.idx for r in rows] == list(range(len(keys)))


@pytest.mark.parametrize("kind", ["string", "double", "date", "decimal(20,3)", "binary", "timestamp"])
def test_row_index_of_any_ordered_key(spark, monkeypatch, kind):
    """With far fewer splitters than rows, and a sample of the keys."""
    monkeypatch.setattr(sampling, "KEY_BITS", 3)
    monkeypatch.setattr(sampling, "SAMPLED_KEYS", 100)
    ids = spark.range(3_000)
    key = {
        "string": "concat('\"a, b\\\\', hex(crc32(cast(id as string))), id)",
        "binary": "cast(concat(char(id % 200), id) AS binary)",
        "date": "date_add(date'1950-01-01', cast(id * 7 AS int))",
        "timestamp": "timestamp_micros(id * 987654321)",
    }.get(kind, f"cast((id * 7919 % 3001 - 1500) / 8 AS {kind})")
    df = ids.selectExpr(f"{key} AS k")
    bounds = sampling._splitters(df, "k")
    assert 7 <= df.select(F.size(bounds)).first()[0] <= 15
    plan = df.select(sampling._key_bucket(df, "k").alias("b"))._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "sort_array" not in plan  # one constant
    rows = sampling.row_index(df, "k", order="key").collect()
    rows.sort(key=lambda r: bytes(r.k) if kind == "binary" else r.k.encode() if kind == "string" else r.k)
    assert [r.idx for r in rows] == list(range(3_000))


def test_row_index_of_nothing(spark, docs):
    empty = docs.filter("id < 0")
    assert sampling.row_index(empty, "id").count() == 0
    assert sampling.row_index(empty, "id", order="key").count() == 0


def test_shuffle_is_a_seeded_permutation(docs):
    orders = [
        [r.id for r in sampling.shuffle_select(docs, "id", seed).collect()]
        for seed in (1, 1, 2, 0)
    ]
    assert orders[0] == orders[1] != orders[2] != orders[3]
    assert sorted(orders[0]) == sorted(orders[2]) == [i * 7 for i in range(60)]


@pytest.mark.parametrize("order", ["hash", "key"])
@pytest.mark.parametrize("key, kind", [("n", "long"), ("t", "string")])
def test_a_null_or_repeated_key_is_an_error(spark, order, key, kind):
    for values, message in ((["1", "2", None], "no key"), (["1", "2", "2", "3"], "key 2")):
        df = spark.createDataFrame([(v,) for v in values], "v string")
        df = df.select(F.col("v").cast(kind).alias(key))
        with pytest.raises(Exception, match=message):
            sampling.row_index(df, key, order=order).collect()
        with pytest.raises(Exception, match=message):
            sampling.sample_rows(df, 1, key, input_key=key).collect()
    other = spark.createDataFrame([(i,) for i in range(9)], "o long")
    df = spark.createDataFrame([(1,), (1,)], "n long")
    with pytest.raises(Exception, match="key 1"):
        sampling.sample_rows(df, 1, "n", input_key="o", source=other, source_key="o").collect()


def test_limit(docs):
    take = sampling.shuffle_select
    assert take(docs, "id", 1, 10).count() == 10
    assert take(docs, "id", 1, 1000).count() == 60
    assert take(docs, "id", 1, 0).count() == 0
    assert sorted(r.id for r in take(docs, "id", None, 3).collect()) == [0, 7, 14]
    assert take(docs, "id").count() == 60
    cases = [(key, seed, n) for key in ("id", "name") for seed in (4, None) for n in (10, 59, 60, 61)]
    for key, seed, n in cases:
        found = [r.id for r in take(docs, key, seed, n).collect()]
        assert found == [r.id for r in docs.orderBy(*(
            [key] if seed is None else [sampling.keyed_hash(seed, F.col(key)), key]
        )).collect()][:n]


def test_first_by_hash_with_full_buckets(docs, monkeypatch):
    monkeypatch.setattr(sampling, "INDEX_BITS", 2)
    order = [r.id for r in sampling.shuffle_select(docs, "id", 9).collect()]
    for wanted in (0, 1, 14, 15, 16, 59, 60, 100):
        found = docs.filter(sampling.first_by_hash(docs, "id", 9, wanted)).collect()
        assert {r.id for r in found} == set(order[:wanted])


def test_splits_and_large_limits_move_no_rows(docs):
    df = sampling.split_column(docs.repartition(3).coalesce(2), "id", 0.1)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize("share", [0.1, 0.05, 0.5, 0.07])
def test_exact_split_is_disjoint_and_complete(docs, share):
    train, dev = sampling.train_dev_split(docs, "id", share, 3)
    train, dev = ({r.id for r in part.collect()} for part in (train, dev))
    assert len(dev) == math.ceil(round(60 * share, 9))
    assert not train & dev and len(train | dev) == 60


def test_drawn_split_needs_no_shuffle(docs, spark):
    df = sampling.split_column(spark.range(4000), "id", 0.25, 1, exact=False)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    share = df.filter("split = 'dev'").count() / 4000
    assert 0.22 < share < 0.28


def test_uniform_draws(spark):
    row = spark.range(20_000).select(keyed_uniform(1, F.col("id")).alias("u")).agg(
        F.min("u"), F.max("u"), F.avg("u"), F.var_pop("u")
    ).first()
    assert 0 <= row[0] < 0.01 and 0.99 < row[1] < 1
    assert abs(row[2] - 0.5) < 0.01 and abs(row[3] - 1 / 12) < 0.005


def test_distinct_draws(spark):
    for k, size in ((1, 2), (3, 4), (5, 6), (3, 40)):
        ids = spark.range(size).select(
            "id", distinct_draws(k, size, 7, F.col("id"), F.col("id")).alias("d")
        )
        for row in ids.collect():
            assert len(set(row.d)) == k and row.id not in row.d
            assert all(0 <= i < size for i in row.d)
    with pytest.raises(ValueError):
        distinct_draws(4, 4, 0, F.col("id"), F.col("id"))


def test_distinct_draws_are_uniform_in_every_position(spark):
    ids = spark.range(12_000).select(distinct_draws(3, 6, 5, F.col("id")).alias("d"))
    for position in range(3):
        counts = [r[1] for r in ids.groupBy(F.col("d")[position]).count().collect()]
        assert len(counts) == 6 and all(abs(c - 2000) < 200 for c in counts)


def test_samples_of_the_same_table(spark, docs):
    def make(k):
        return sampling.sample_rows(docs, k, "id", 2, "s", input_key="name")

    same_for_any_partitioning(spark, lambda: make(3))
    for row in make(3).collect():
        assert len(set(row.s)) == 3 and row.name not in row.s
    rows = make(1).collect()
    assert len(rows) == 60 and all(isinstance(r.s, str) and r.s != r.name for r in rows)
    wrapped = sampling.sample_rows(docs, 1, "id", 2, "s", "name", unwrap=False)
    assert sorted((r.id, r.s[0]) for r in wrapped.collect()) == sorted(
        (r.id, r.s) for r in rows
    )


def test_samples_of_another_table(spark, docs):
    other = spark.createDataFrame([(i, f"o{i}") for i in range(4)], "oid int, text string")
    df = sampling.sample_rows(docs, 4, "id", 1, "s", "text", source=other, source_key="oid")
    assert all(sorted(r.s) == ["o0", "o1", "o2", "o3"] for r in df.collect())
    # The same table by name may give a row itself.
    df = sampling.sample_rows(docs, 60, "id", 1, "s", "name", source=docs)
    assert all(r.name in r.s for r in df.collect())
    with pytest.raises(ValueError):
        sampling.sample_rows(docs, 60, "id")


def test_samples_of_a_large_table_are_not_copied(spark):
    big = spark.range(6000).withColumn("v", F.col("id") * 2)
    df = sampling.sample_rows(big, 2, "id", 1, "s", input_key="v")
    assert df.filter("size(array_distinct(s)) = 2 and not array_contains(s, v)").count() == 6000


def test_flattened_lists(docs):
    df = sampling.sample_rows(docs, 2, "id", 1, "s", "passages", flatten=True)
    assert all(len(r.s) == 4 for r in df.collect())


def test_few_shot_keeps_named_columns_and_its_list(docs):
    row = sampling.few_shot(docs, 1, "id", columns=["name"]).first()
    assert len(row.fewshot) == 1 and row.fewshot[0].asDict().keys() == {"name"}
    row = sampling.few_shot(docs, 2, "id").first()
    assert row.fewshot[0].asDict().keys() == {"id", "name", "passages", "x"}


def test_mix_distractors(spark):
    df = spark.range(2000).select(
        "id",
        F.array(F.lit("p1"), F.lit("p2"), F.lit("p3")).alias("positive_passages"),
        F.when(F.col("id") > 0, F.array(F.lit("n1"), F.lit("n2"))).alias("negative_passages"),
    )
    rows = sampling.mix_distractors(df, "id", 1, k=2, raft_p=0.3, neg_docs_num=1).collect()
    both = sum(r.docs == ["p1", "p2", "n1"] for r in rows)
    negative = sum(r.docs == ["n1"] for r in rows)
    assert rows[0].docs in (["p1", "p2"], [])
    assert both + negative == 1999 and abs(both / 1999 - 0.7) < 0.04
    rows = sampling.mix_distractors(df.drop("negative_passages"), "id", 1, raft_p=2).collect()
    assert all(r.docs == [] for r in rows)
    rows = sampling.mix_distractors(df.drop("negative_passages"), "id", 1, raft_p=-1).collect()
    assert all(r.docs == ["p1", "p2", "p3"] for r in rows)


def test_merge_tables(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id int, a string")
    b = spark.createDataFrame([(1, "y")], "id int, b string")
    merged = sampling.merge_tables({"a": a, "b": b}, seed=1, key="id", keyword="source")
    assert collected(merged.select("id", "a", "b", "source")) == [
        ("1", "None", "y", "b"),
        ("1", "x", "None", "a"),
        ("1", "x", "None", "a"),
    ]
    assert sampling.merge_tables([a, a]).count() == 4
    with pytest.raises(ValueError):
        sampling.merge_tables([a, b], seed=1)
