import pytest
from pyspark.sql import functions as F

from loomdex.operators import duplicates, relational
from loomdex.operators.skew import salted_join
from loomdex.plans.jobs import prepare_motions


def test_null_keys_match_unless_switched_off(spark):
    docs = spark.createDataFrame([("d1", None), ("d2", "1")], "dokument_uid string, dokument_geschaeft_uid string")
    items = spark.createDataFrame([(None, "t0"), ("1", "t1")], "geschaeft_uid string, titel string")
    both = relational.merge_documents(docs, items)
    assert {(r.dokument_uid, r.titel) for r in both.collect()} == {("d1", "t0"), ("d2", "t1")}
    strict = relational.merge_documents(docs, items, null_safe=False)
    assert [r.dokument_uid for r in strict.collect()] == ["d2"]


def test_shared_names_get_suffixes(spark):
    left = spark.createDataFrame([(1, "a")], "k int, v string")
    right = spark.createDataFrame([(1, "b")], "k int, v string")
    got = relational.merge_documents(left, right, "k", "k")
    assert got.columns == ["k_x", "v_x", "k_y", "v_y"]
    assert tuple(got.first()) == (1, "a", 1, "b")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join_with_a_hot_key(spark, how):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("row"),
    ).repartition(8)
    right = spark.range(0, 2500).select(F.col("id").alias("j"), (F.col("id") * 2).alias("v")).union(
        spark.createDataFrame([(None, -1), (7, -7)], "j long, v long")
    )
    for null_safe in (True, False):
        same = left.k.eqNullSafe(right.j) if null_safe else left.k == right.j
        want = left.join(right, same, how)
        got = salted_join(left, right, [("k", "j")], how, null_safe, salts=5)
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0
    with pytest.raises(ValueError):
        salted_join(left, right, [("k", "j")], "full")


def test_hot_key_is_spread_over_tasks(spark):
    left = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("k"), F.col("id").alias("row"))
    right = spark.createDataFrame([(1, "x")], "j int, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(left, right, [("k", "j")], salts=64)
        sizes = [len(p) for p in joined.rdd.glom().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 8000 and max(sizes) < 8000


def test_key_spreads_when_the_left_side_is_partitioned_by_it(spark):
    left = spark.range(0, 8000).select(F.when(F.col("id") < 40, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"))
    right = spark.createDataFrame([(1, "x")], "j int, v string")
    joined = salted_join(left.repartition(8, "k"), right.hint("shuffle_hash"), [("k", "j")], salts=16)
    assert joined.count() == 40
    parts = left.where("k = 1").select(F.pmod(F.xxhash64("k", "row"), F.lit(16))).distinct().count()
    assert parts >= 10


def test_repeats_among_documents_of_one_motion(spark):
    rows = [("1", "a", "x"), ("1", "b", " x "), ("1", "c", "y"), ("2", "a", "x"), ("2", "d", None)]
    df = spark.createDataFrame(rows, "m string, d string, text string").withColumn("status", F.lit("success"))
    got = {(r.m, r.d): r.status for r in duplicates.dedup_clean_text(df, ["m", "d"]).collect()}
    assert got == {("1", "a"): "success", ("1", "b"): "duplicate", ("1", "c"): "success", ("2", "a"): "duplicate", ("2", "d"): "success"}
    with pytest.raises(Exception, match="rows repeat in key and text"):
        duplicates.dedup_clean_text(df.union(df), ["m", "d"]).collect()


def test_rows_are_deduplicated_with_nulls_equal(spark):
    rows = [(1, None), (1, None), (2, "a"), (2, "a"), (2, "a"), (3, "b")]
    df = spark.createDataFrame(rows, "a int, b string")
    once = duplicates.dedup_rows(df)
    assert once.count() == 3 and duplicates.dedup_rows(once).count() == 3
    flags = duplicates.dup_flag_rows(df).groupBy("a").agg(F.count_if("is_duplicate").alias("n"))
    assert {r.a: r.n for r in flags.collect()} == {1: 1, 2: 2, 3: 0}
    assert duplicates.has_duplicates(df).first()[0] is True
    assert duplicates.has_duplicates(once).first()[0] is False
    assert duplicates.has_duplicates(df.where("a > 9")).first()[0] is False


def test_repeats_beyond_one_chunk(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "REPEAT_CHUNK", 7)
    df = spark.range(100).select(F.lit("same").alias("a"))
    flags = duplicates.dup_flag_rows(df)
    assert flags.count() == 100 and flags.where("not is_duplicate").count() == 1


def test_lowest_key_stays_unique_and_text_is_kept(spark):
    rows = [(3, "success", " a  b"), (1, "success", "a b "), (2, "failed", "a b"), (4, "success", None), (5, "success", "c")]
    df = spark.createDataFrame(rows, "k long, status string, text string")
    got = {r.k: (r.status, r.text) for r in duplicates.dedup_clean_text(df, "k").collect()}
    assert got == {
        1: ("success", "a b "), 2: ("failed", "a b"), 3: ("duplicate", " a  b"), 4: ("success", None), 5: ("success", "c"),
    }


def test_a_key_of_two_columns(spark):
    rows = [("m", 2, "success", "x"), ("m", 1, "success", "x"), ("l", 9, "success", "x")]
    df = spark.createDataFrame(rows, "m string, d int, status string, text string")
    got = {(r.m, r.d): r.status for r in duplicates.dedup_clean_text(df, ["m", "d"]).collect()}
    assert got == {("l", 9): "success", ("m", 1): "duplicate", ("m", 2): "duplicate"}


def test_a_third_of_all_texts_equal(spark):
    df = spark.range(3000).select(
        "id", F.lit("success").alias("status"),
        F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("text"),
    )
    got = duplicates.status_summary(duplicates.dedup_clean_text(df, "id"))
    assert {r.status: r.n for r in got.collect()} == {"success": 2001, "duplicate": 999}


def test_prepared_motions(spark):
    docs = spark.createDataFrame(
        [("d1", "1", "Vorstoss"), ("d1", "1", "Vorstoss"), ("d2", "1", "Antwort"), ("d3", "2", "Vorstoss"), ("d4", "1", None)],
        "dokument_uid string, dokument_geschaeft_uid string, dokument_typ_deutsch string",
    )
    items = spark.createDataFrame([("1", "Motion"), ("2", "Postulat"), ("3", None)], "geschaeft_uid string, geschaeft_typ_deutsch string")
    assert [r.dokument_uid for r in prepare_motions(docs, items).collect()] == ["d1"]
    late = relational.filter_motions(relational.merge_documents(docs, items))
    assert [r.dokument_uid for r in duplicates.dedup_rows(late).collect()] == ["d1"]


def test_localized_fields(spark):
    names = ["titel_deutsch", "titel_franz", "beschluss_deutsch", "beschluss_franz"]
    rows = [(t, "td", "tf", "bd", "bf") for t in ("Deutsch und Französisch", "Französisch", "Französisch, Italienisch", None)]
    df = spark.createDataFrame(rows, "dokument_ziel_publikation string, " + ", ".join(f"geschaeft_{n} string" for n in names))
    got = [(r.title, r.beschluss) for r in relational.localized_fields(df).collect()]
    assert got == [("td", "bd"), ("tf", "bf"), (None, None), (None, None)]


def test_samples(spark):
    df = spark.range(10)
    assert relational.sample_head(df, "all", ["id"]).count() == 10
    assert relational.sample_head(df, 0, ["id"]).count() == 10
    assert [r.id for r in relational.sample_head(df, "3", ["id"]).collect()] == [0, 1, 2]
    for bad in ("some", "-1", -1):
        with pytest.raises(ValueError):
            relational.sample_head(df, bad, ["id"])


def test_last_url_wins(spark):
    rows = spark.createDataFrame([("a", "u1", 1), ("a", "u2", 2)], "k string, url string, ord int")
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    got = {r.k: r.url for r in relational.keyed_url_lookup(df, rows, "k").collect()}
    assert got == {"a": "u2", "b": relational.URL_MISSING}
