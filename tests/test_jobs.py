import numpy as np
import pytest
from pyspark.sql import functions as F

from loomdex.operators import extract, layout, retrieval
from loomdex.plans import jobs
from loomdex.session import scratch_path, shared_folder
from loomdex.sources import readers, sinks
from loomdex.sources.collections import PAYLOAD_FIELDS, CollectionExists, CollectionMissing, Collections


@pytest.fixture
def store(spark):
    return Collections(spark, scratch_path(spark, "store"))


def motions(spark):
    items = spark.createDataFrame(
        [(str(n), "Motion", f"Titel {n}", f"Titre {n}", "ja", "oui") for n in range(6)],
        readers.ITEM_SCHEMA,
    )
    targets = ["Deutsch", "Französisch", "Deutsch und Französisch", None, "Deutsch", "Deutsch"]
    docs = spark.createDataFrame(
        [(f"d{n}", str(n), "Vorstoss", targets[n], f"u{n}") for n in range(6)], readers.DOCUMENT_SCHEMA
    )
    texts = ["solar roof  power", "wind power plant", "school bus", "tram line power", None, "  "]
    content = spark.createDataFrame(
        [(f"u{n}", None if t is None else bytearray(t.encode())) for n, t in enumerate(texts)],
        "url string, content binary",
    )
    return docs, items, content


def test_extraction_outcomes(spark):
    rows = [("1", b"<p>Hi &amp; bye</p><script>x</script>", "u"), ("2", None, "u"), ("3", b"<p> </p>", "u"), ("4", b"", "u")]
    df = spark.createDataFrame([(k, None if c is None else bytearray(c), u) for k, c, u in rows], "motion_id string, content binary, url string")
    got = {r.motion_id: (r.status, (r.text or "").strip() or None, r.error_message) for r in extract.extract_text_job(df).collect()}
    assert got == {
        "1": ("success", "Hi & bye", None),
        "2": ("failed", None, extract.DOWNLOAD_FAILED),
        "3": ("failed", None, extract.NO_TEXT),
        "4": ("failed", None, extract.NO_TEXT),
    }
    kept = extract.extract_text_job(df, blank_is_failure=False).where("motion_id = '3'").first()
    assert kept.status == "success"


def test_extractor_hook_and_registry(spark):
    def shout(data):
        if data == b"bad":
            raise RuntimeError("cannot read")
        return data.decode().upper() or None

    df = spark.createDataFrame(
        [("1", bytearray(b"ok"), "u"), ("2", bytearray(b"bad"), "u"), ("3", None, "u"), ("4", bytearray(b""), "u")],
        "motion_id string, content binary, url string",
    )
    got = {r.motion_id: (r.status, r.text, r.error_message) for r in extract.extract_text_job(df, extractor=shout).collect()}
    assert got == {
        "1": ("success", "OK", None),
        "2": ("error_in_future", None, "cannot read"),
        "3": ("failed", None, extract.DOWNLOAD_FAILED),
        "4": ("failed", None, extract.NO_TEXT),
    }
    extract.register_extractor("Shout", shout)
    assert extract.resolve_extractor("shout") is shout
    with pytest.raises(ValueError):
        extract.resolve_extractor("nothing")
    assert extract.resolve_extractor("nothing", fallback="html") is extract.COLUMN_EXTRACTORS["html"]
    twice = df.unionAll(df.withColumn("motion_id", F.concat("motion_id", F.lit("x"))))
    marked = jobs.extract_dedup_job(twice, extractor="shout")
    assert {r.motion_id: r.status for r in marked.collect() if "1" in r.motion_id} == {"1": "success", "1x": "duplicate"}


def test_pages_in_order_and_missing_page(spark):
    df = spark.createDataFrame([("a", 2, "two"), ("a", 1, "one"), ("b", 1, None), ("b", 2, "x")], "doc string, page_no int, text string")
    assert {r.doc: r.text for r in extract.assemble_pages(df).collect()} == {"a": "one\ntwo\n", "b": None}


def test_marker_share(spark):
    df = spark.createDataFrame([("Antrag Regierungsrat x",), ("no",), ("no",), ("no",)], "text string")
    assert extract.marker_coverage(df).first().percent == 25.0
    assert extract.marker_coverage(df.where("false")).first().percent is None


def test_csv_round_trip_with_quotes_lines_and_null_words(spark):
    rows = [("1", "Motion", 'say "x", y', "line\nend", None, "NaN")]
    path = scratch_path(spark, "csv")
    sinks.write_csv(spark.createDataFrame(rows, readers.ITEM_SCHEMA), path)
    assert [tuple(r) for r in readers.scan_csv(spark, path, readers.ITEM_SCHEMA, multi_line=True).collect()] == [
        ("1", "Motion", 'say "x", y', "line\nend", None, None)
    ]
    raw = readers.scan_csv(spark, path, readers.ITEM_SCHEMA, null_words=False, multi_line=True).first()
    assert raw.geschaeft_beschluss_franz == "NaN"


def test_csv_values_with_line_breaks_are_whole_by_default(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,"long\nname",text\n1,x,"one\n\ntwo, ""three"""\n2,y,z\n', encoding="utf-8")
    schema = "text string, id long, `long\nname` string"
    got = readers.scan_csv(spark, str(tmp_path), spark.createDataFrame([], schema).schema).orderBy("id").collect()
    assert [tuple(r) for r in got] == [('one\n\ntwo, "three"', 1, "x"), ("z", 2, "y")]


def test_files_as_rows(spark, tmp_path):
    (tmp_path / "a.b.txt").write_text("eins\nzwei", encoding="utf-8")
    (tmp_path / "c.md").write_text("no")
    (tmp_path / "d.pdf").write_bytes(b"%PDF")
    assert [tuple(r) for r in readers.scan_text_files(spark, str(tmp_path)).collect()] == [("a.b", "eins\nzwei")]
    got = readers.scan_binary_docs(spark, str(tmp_path)).collect()
    assert [(r.name, bytes(r.content)) for r in got] == [("d.pdf", b"%PDF")]


def test_status_areas(spark):
    df = spark.createDataFrame(
        [("1", "success", "t", bytearray(b"1")), ("2", "duplicate", "t", None), ("3", "failed", None, None)],
        "motion_id string, status string, text string, content binary",
    )
    texts, data = scratch_path(spark, "t"), scratch_path(spark, "b")
    sinks.write_text_by_key(df, texts)
    sinks.write_binary_by_key(df, data)
    assert {(r.motion_id, r.area) for r in spark.read.parquet(texts).collect()} == {("1", "extracted"), ("2", "duplicates")}
    assert [r.motion_id for r in spark.read.parquet(data).collect()] == ["1"]


def test_collections_life_cycle(store):
    assert store.list() == [] and not store.exists("a") and not store.delete("a")
    with pytest.raises(ValueError):
        store.create("a", 8, 2, prefixes=(4, 64))
    assert store.create("a", 8, 2, prefixes=(4,), quantised=()) and store.list() == ["a"]
    assert store.config("a")["prefixes"] == [4]
    assert store.create("a", exist_ok=True) is False
    with pytest.raises(CollectionExists):
        store.create("a")
    assert store.points("a").count() == 0 and store.vector_size("a") is None and store.vocabulary("a") is None
    assert store.create("a", recreate=True) and store.delete("a") and not store.exists("a")
    with pytest.raises(CollectionMissing):
        store.points("a")
    with pytest.raises(ValueError):
        store.create("../a")


def test_stored_codes_follow_the_points(spark, store):
    rng = np.random.default_rng(2)

    def some(ids, spread):
        rows = [(f"{i:03d}", [float(x) for x in rng.normal(0, 1, 4) * [spread, 1, 1, 1]], [1.0], ("u", "d", "x", f"t{i}", "b", "w")) for i in ids]
        return spark.createDataFrame(rows, "id string, text_dense array<float>, text_sparse array<double>, payload struct<geschaeft_uid:string,dokument_uid:string,url:string,title:string,beschluss:string,text:string>")

    def checked():
        bounds = store.code_bounds("c")
        assert bounds == store.bounds("c")
        want = store.read("c").select("id", retrieval.code_column("text_dense", bounds).alias("codes"))
        assert sorted(map(tuple, store.codes("c").collect())) == sorted(map(tuple, want.collect()))
        asked = spark.createDataFrame([(q, [float(x) for x in rng.normal(0, 1, 4)]) for q in range(3)], "qid int, text_dense array<float>")
        rows = store.read("c").select("id", "text_dense")
        args = (asked, (2, 3), (8, 4), bounds)
        found = retrieval.coded_cascade(store.codes("c"), rows, *args)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, retrieval.matryoshka_cascade(rows, *args).collect()))

    store.create("c", 4, 1, prefixes=(2, 3), quantised=(2,), bucket_chars=1, coded=True)
    assert store.codes("c").count() == 0
    corners = [(f"{i}", [*map(float, xy), 0.0, 0.0], [1.0], None) for i, xy in enumerate([(1, 0), (-1, 0), (0, 1), (0, -1)])]
    wide = some(range(4), 1).union(spark.createDataFrame(corners, some([0], 1).schema))
    assert store.upsert("c", some(range(10, 20), 0.01)) == 10
    first = store.state("c")["codes"]
    checked()
    assert store.upsert("c", wide) == 8  # they widen the range, so all codes are made anew
    second = store.state("c")["codes"]
    checked()
    assert store.upsert("c", some(range(30, 36), 0.5)) == 6 and store.upsert("c", some(range(30, 36), 0.5)) == 0
    assert store.state("c")["codes"] == second != first
    checked()
    store.create("plain", 4, 1, prefixes=(2,), quantised=(2,))
    with pytest.raises(ValueError):
        store.codes("plain")


def test_coarse_search_of_a_collection(spark, store):
    docs, items, content = motions(spark)
    store.create("m", 256, 256, bucket_chars=1, indexed=True, coded=True)
    assert jobs.build_index(store, "m", docs, items, content, extractor="text", dim=256, bucket_chars=1) == 3
    asked = spark.createDataFrame([(1, "wind power plant"), (2, "School bus")], "qid int, text string")
    found = jobs.search_coarse(store, "m", asked, limit=2).orderBy("qid", "rank").collect()
    assert [(r.qid, r.rank) for r in found] == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert [r.payload.dokument_uid for r in found if r.rank == 1] == ["d1", "d2"]


def test_index_search_and_repeat(spark, store):
    docs, items, content = motions(spark)
    args = (store, "m", docs, items, content)
    options = dict(extractor="text", dim=256, bucket_chars=1)
    assert jobs.build_index(*args, **options) == 3
    assert jobs.build_index(*args, **options) == 0
    points = store.read("m")
    assert points.count() == 3 and points.columns == ["id", "text_dense", "m64", "m128", "m256", "text_sparse", "payload"]
    # the document without a target is not stored, but its words count
    vocab = {r.token: r.n for r in store.vocabulary("m").collect() if r.token}
    assert vocab["power"] == 3 and vocab["tram"] == 1
    assert store.vector_size("m") == 256
    assert set(store.bounds("m")) == {64, 128}

    again = Collections(spark, store.root)  # nothing but the catalog is needed
    asked = spark.createDataFrame([(1, "wind power plant"), (2, "School bus")], "qid int, text string")
    found = jobs.search_similar(again, "m", asked, limit=2).orderBy("qid", "rank").collect()
    assert [(r.qid, r.rank) for r in found] == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert [r.payload.dokument_uid for r in found if r.rank == 1] == ["d1", "d2"]
    assert [(r.payload.title, r.payload.beschluss) for r in found if r.rank == 1] == [("Titre 1", "oui"), ("Titel 2", "ja")]
    # every query token that the vocabulary knows has weight one
    sparse = jobs.query_vectors(asked, store.vocabulary("m"), dim=256).where("qid = 1").first().text_sparse
    assert sorted(sparse)[-4:] == [0, 1, 1, 1]


def test_random_ids_append_again(spark, store):
    docs, items, content = motions(spark)
    for _ in range(2):
        assert jobs.build_index(store, "m", docs, items, content, extractor="text", dim=256, random_ids=True, bucket_chars=1) == 3
    assert store.points("m").select("id").distinct().count() == 6


def test_append_weighs_stored_points_anew(spark, store):
    docs, items, content = motions(spark)
    options = dict(extractor="text", dim=256, bucket_chars=1)
    one, two = (Collections(spark, f"{store.root}-{n}") for n in (1, 2))
    assert jobs.build_index(one, "m", docs, items, content, **options) == 3
    twice = content.union(content)  # landed twice: still one content for an address
    assert jobs.build_index(two, "m", docs.where("dokument_uid in ('d0', 'd3')"), items, twice, **options) == 1
    assert jobs.build_index(two, "m", docs, items, twice, **options) == 2
    assert jobs.build_index(two, "m", docs, items, content, **options) == 0
    assert two.version("m") == 2 and one.version("m") == 1

    def weights(s):
        return {r.id: (r.text_sparse, r.payload.text) for r in s.read("m").collect()}

    assert weights(one) == weights(two)
    assert one.vocabulary("m").exceptAll(two.vocabulary("m")).count() == 0
    # documents that are not given again keep their share in the statistics
    assert jobs.build_index(two, "m", docs.where("dokument_uid = 'd4'"), items, content, **options) == 0
    assert {r.token for r in two.vocabulary("m").collect()} >= {"solar", "wind", "school"}


def index_of(s):
    words = {r.token: (r.n, r.idf) for r in s.vocabulary("m").collect()}
    return words, {r.id: (r.text_sparse, r.payload.text) for r in s.read("m").collect()}


def test_append_reads_no_stored_text_while_the_vocabulary_stays(spark, store, monkeypatch):
    docs, items, content = motions(spark)
    options = dict(extractor="text", dim=256, bucket_chars=1)
    known = content.withColumn("content", F.when(F.col("url") == "u2", F.lit(b"power wind solar")).otherwise(F.col("content")))
    known = known.where("url in ('u0', 'u1', 'u2')")
    jobs.build_index(store, "m", docs.where("dokument_uid in ('d0', 'd1')"), items, known, **options)
    table, before = store.state("m")["points"], index_of(store)
    monkeypatch.setattr(jobs, "reindexed", lambda *a: pytest.fail("stored texts are read"))
    assert jobs.build_index(store, "m", docs.where("dokument_uid in ('d0', 'd1', 'd2')"), items, known, **options) == 1
    assert store.state("m")["points"] == table and store.statistics("m").where("token is null").first().df == 3
    after = index_of(store)
    assert after[0]["roof"][1] != before[0]["roof"][1]  # a stored point's weights follow
    once = Collections(spark, f"{store.root}-once")
    jobs.build_index(once, "m", docs.where("dokument_uid in ('d0', 'd1', 'd2')"), items, known, **options)
    assert index_of(once) == after


@pytest.mark.parametrize("words", ["power wind", "new words here"])
def test_a_build_that_breaks_off_leaves_the_index(spark, store, monkeypatch, words):
    docs, items, content = motions(spark)
    content = content.withColumn("content", F.when(F.col("url") == "u2", F.lit(words.encode())).otherwise(F.col("content")))
    options = dict(extractor="text", dim=256, bucket_chars=1)
    first, every = docs.where("dokument_uid in ('d0', 'd1')"), docs.where("dokument_uid in ('d0', 'd1', 'd2')")
    jobs.build_index(store, "m", first, items, content, **options)
    before = index_of(store)
    for step in ("vocabulary", "statistics", "counted", "points", "publish"):
        with monkeypatch.context() as m:

            def fail(self, *args, save=Collections._save, append=Collections._append):
                if step == "publish" or step == "points" or args[1] == step:
                    raise RuntimeError(f"lost at {step}")
                return save(self, *args)

            m.setattr(Collections, {"points": "_append", "publish": "_publish"}.get(step, "_save"), fail)
            with pytest.raises(RuntimeError, match=step):
                jobs.build_index(store, "m", every, items, content, **options)
        words_now, points = index_of(store)
        assert words_now == before[0] and {i: points[i] for i in before[1]} == before[1], step
    assert jobs.build_index(store, "m", every, items, content, **options) in (0, 1)  # a lost append may have got its points in
    once = Collections(spark, f"{store.root}-once")
    jobs.build_index(once, "m", every, items, content, **options)
    assert index_of(once) == index_of(store)
    named = {t for p in ("points", "vocabulary", "statistics") for t in [store.state("m")[p]]}
    assert named < set(store._tables("m")) and len(store._tables("m")) <= 14  # broken-off tables are gone


def test_a_build_can_be_entered_into_another_catalog(spark, store):
    docs, items, content = motions(spark)
    jobs.build_index(store, "m", docs, items, content, extractor="text", dim=256, bucket_chars=1)
    state, want = store.state("m"), index_of(store)
    copy = f"{store.root}-copy"
    from loomdex.session import remove_path

    for table in [state["points"], state["vocabulary"], state["statistics"], *state["bounds"], *state["counted"]]:
        spark.read.parquet(f"{store.root}/{table}").write.parquet(f"{copy}/{table}")
    other = Collections(spark, copy)
    points = spark.read.parquet(f"{store.root}/{state['points']}")
    remove_path(spark, f"{copy}/{state['points']}")
    points.write.partitionBy("id_bucket").parquet(f"{copy}/{state['points']}")
    other.restore("m", state)
    assert index_of(other) == want and other.list() == ["m"]


def test_an_append_meets_only_stored_ids_of_its_buckets(spark, store, capsys):
    store.create("b", 4, 1, prefixes=(2,), quantised=(), bucket_chars=1)
    empty = F.struct(*[F.lit(None).cast("string").alias(n) for n in PAYLOAD_FIELDS])

    def points(*ids):
        rows = [(i, [1.0, 0.0, 0.0, 0.0], [0.0]) for i in ids]
        return spark.createDataFrame(rows, "id string, text_dense array<double>, text_sparse array<double>").withColumn("payload", empty)

    assert store.without_known(points("a1"), "b").count() == 1  # nothing is stored yet
    assert store.upsert("b", points(*[f"{bucket}{i}" for bucket in "abcdef" for i in range(5)])) == 30
    new = store.without_known(points("a1", "a7", "b4", "x1", None), "b")
    assert sorted(str(r.id) for r in new.collect()) == ["None", "a7", "x1"]
    capsys.readouterr()
    new.explain("formatted")
    assert "dynamicpruning" in capsys.readouterr().out
    assert store.upsert("b", points("a1", "a7", "b4", "x1", "x1")) == 2


def test_equal_ids_of_a_batch_are_stored_once(spark, store):
    store.create("b", 4, 1, prefixes=(2,), quantised=(2,), payload=None)
    rows = [("x", [1.0, 0.0, 0.0, 0.0], [0.0])] * 3 + [("y", [0.0, 1.0, 0.0, 0.0], [0.0])]
    points = spark.createDataFrame(rows, "id string, text_dense array<double>, text_sparse array<double>")
    empty = F.struct(*[F.lit(None).cast("string").alias(n) for n in PAYLOAD_FIELDS])
    points = points.withColumn("payload", empty)
    assert store.upsert("b", points) == 2 and store.upsert("b", points) == 0
    broken = points.withColumn("id", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        store.upsert("b", broken, skip_known=False)


def test_samples_limit_the_index(spark, store):
    docs, items, content = motions(spark)
    assert jobs.build_index(store, "m", docs, items, content, extractor="text", dim=256, samples="2", bucket_chars=1) == 2


def test_nothing_extracted_gives_an_empty_padded_vocabulary(spark, store):
    docs, items, content = motions(spark)
    assert jobs.build_index(store, "m", docs, items, content.where("url = 'u5'"), extractor="text", dim=256) == 0
    assert store.vocabulary("m").where("token = ''").count() == 256
    asked = spark.createDataFrame([(1, "x")], "qid int, text string")
    assert jobs.search_similar(store, "m", asked).count() == 0


def test_lookup_of_hits_prunes_partitions(spark, store):
    docs, items, content = motions(spark)
    jobs.build_index(store, "m", docs, items, content, extractor="text", dim=256, bucket_chars=1)
    asked = spark.createDataFrame([(1, "power")], "qid int, text string")
    found = jobs.search_similar(store, "m", asked, limit=1)
    assert len(found.collect()) == 1
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "dynamicpruning" in plan and "ReusedExchange" in plan


def test_demo_search_uses_keywords(spark):
    documents = spark.createDataFrame([(1, "alpha beta"), (2, "gamma delta"), (3, "epsilon")], "id long, text string")
    asked = spark.createDataFrame([(1, "alpha beta", ["Gamma"])], "qid int, text string, keywords array<string>")
    found = {r.payload.text: r.score for r in jobs.demo_search(documents, asked, limit=3).collect()}
    # first on both dense branches, second on keywords; and the other way round
    assert found["alpha beta"] == pytest.approx(1 / 2 + 1 / 2 + 1 / 3)
    assert found["gamma delta"] == pytest.approx(1 / 2 + 1 / 3 + 1 / 3)


def test_staged_table_is_removed(spark):
    with jobs.staged(spark.range(3)) as rows:
        path = rows.inputFiles()[0].rsplit("/", 1)[0]
        assert rows.count() == 3
    from loomdex.session import remove_path

    assert remove_path(spark, path) is False
    assert path.replace("file://", "").startswith(shared_folder(spark))


def test_scratch_is_cleared_on_request(spark, monkeypatch):
    from loomdex import session

    monkeypatch.setattr(session, "_made", [])
    rows = session.written(spark.range(3), "kept")
    assert rows.count() == 3 and session.clear_scratch(spark) == 1 and session.clear_scratch(spark) == 0


def test_a_shared_folder_is_needed(spark, monkeypatch):
    from loomdex import session

    class Bare:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError):
        session.shared_folder(Bare())


def test_layout_round_trip_and_ranking(spark):
    rows = [("d", 1, n, n % 3, float(n), 0.0, n + 2.0, 4.0, [0.9, 0.2, 0.5, 0.9, 0.7, 0.6, 0.8][n]) for n in range(7)]
    flat = spark.createDataFrame(rows, "doc string, page_number int, element_id int, type int, x1 double, y1 double, x2 double, y2 double, confidence double")
    elements = flat.select("doc", "page_number", "element_id", "type", F.struct("x1", "y1", "x2", "y2").alias("coordinates"), "confidence")
    back = layout.layout_elements(layout.layout_pages(elements)).select(*elements.columns)
    assert back.exceptAll(elements).count() == 0 and back.count() == 7
    report = layout.layout_report(elements).orderBy("rank").collect()
    assert [r.element_id for r in report] == [0, 3, 6, 4, 5]
    assert (report[0].width, report[0].height, report[0].colour, report[0].label) == (2.0, 4.0, "red", "Type: 0, Conf: 0.90")
