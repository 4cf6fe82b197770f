import pytest
from conftest import rows
from pyspark.sql import functions as F

from fieldprep.plans.polygons import RowFilter
from fieldprep.session import cut_lineage, shared_folder
from fieldprep.sources import readers, sinks
from fieldprep.sources import versions
from fieldprep.streaming import append, ledger
from fieldprep.streaming.append import append_new, append_stream


def test_titled_csv(spark, tmp_path):
    path = tmp_path / "2018.csv"
    path.write_text('All inspections,,\nFound,Station,Found\nyes,"a, b",no\n,007,\n')
    df = readers.read_titled_csv(spark, str(path))
    assert df.columns == ["Found...1", "Station", "Found...3"]
    assert {t for _, t in df.dtypes} == {"string"}
    assert rows(df) == [("yes", "a, b", "no"), (None, "007", None)]
    assert list(readers.read_year_tables(spark, {2018: str(path)})) == [2018]


def test_extracts_are_united_by_name_and_numbered_by_position(spark, tmp_path):
    (tmp_path / "metabase_7.csv").write_text("a,b\n1,2\n")
    (tmp_path / "metabase_8 late.csv").write_text("b,c,a\n3,4,5\n")
    (tmp_path / "notes.csv").write_text("a\n9\n")
    df = readers.read_extracts(spark, str(tmp_path))
    assert rows(df, "Year", "a", "b", "c") == [(2020, "1", "2", None), (2021, "5", "3", "4")]
    with pytest.raises(ValueError):
        readers.read_extracts(spark, str(tmp_path), pattern="nothing")


def test_options(spark, tmp_path):
    names = [f.name for f in readers.fields(readers.Options)]
    path = tmp_path / "opts.csv"
    path.write_text(",".join(names) + "\n" + ",".join("2024" if n == "year" else f"/{n}" for n in names) + "\n")
    assert readers.read_options(spark, str(path)).year == 2024
    renamed = path.read_text().replace("spatial_folder", "maps")
    path.write_text(renamed)
    assert readers.read_options(spark, str(path), {"spatial_folder": "maps"}).spatial_folder == "/maps"
    with pytest.raises(ValueError):
        readers.read_options(spark, None)
    path.write_text("year\n2024\n")
    with pytest.raises(ValueError):
        readers.read_options(spark, str(path))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2020, "a"), (2021, "b")], "Year int, v string")
    sinks.write_table(df, str(tmp_path / "t"), partition_by=["Year"])
    sinks.write_table(df.limit(1), str(tmp_path / "t"), partition_by=["Year"], gather=True)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    paths = sinks.write_tables({"x": df}, str(tmp_path), "csv")
    assert readers.read_lookup(spark, paths["x"]).dtypes == [("Year", "string"), ("v", "string")]
    sinks.write_ordered(df, str(tmp_path / "o"), [F.col("Year").desc()])
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_cache_builds_once_and_on_request(spark, tmp_path):
    path, built = str(tmp_path / "cache"), []

    def build():
        built.append(1)
        return spark.range(len(built))

    assert sinks.read_or_build(spark, path, build).count() == 1
    assert sinks.read_or_build(spark, path, build).count() == 1
    assert sinks.read_or_build(spark, path, build, refresh=True).count() == 2
    assert len(built) == 2


def test_labels():
    assert RowFilter().label(None).endswith("_all_years")
    assert RowFilter("Station", ("x",)).label(2024).endswith("_2024_Station_filtered")
    assert RowFilter(preset="WD_infected_areas").label(2024).endswith("_2024_WD_Infected_Areas")
    assert RowFilter(preset="BC_WD_infected_wbs").label(None).endswith("_all_years_BC_WD_Infected_Waterbodies")
    assert RowFilter(preset="BC_WD_infected_wbs").label(2024).endswith("_2024")


def test_observed_counts(spark):
    df, seen = sinks.counted(spark.range(10), "ten", even=F.col("id") % 2 == 0)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}


def test_shared_folder_is_reliable_storage(spark):
    assert shared_folder(spark)
    assert cut_lineage(spark.range(3)).count() == 3


RAW = "Year int, id string, v string"


def test_append_ignores_what_is_stored(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(2020, "1", "b"), (2020, "1", "a"), (2020, None, "n"), (None, "1", "x")], RAW)
    for _ in range(2):
        append_new(batch, path, ["Year", "id"], "Year")
    later = spark.createDataFrame([(2021, "1", "c"), (2020, "1", "z")], RAW)
    append_new(later, path, ["Year", "id"], "Year")
    stored = spark.read.schema(RAW).parquet(path)
    assert rows(stored, "Year", "id", "v") == [(2020, "1", "a"), (2020, None, "n"), (2021, "1", "c"), (None, "1", "x")]


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "t")
    source.mkdir()
    lines = [(y, i, f"v{i}") for y in (2020, 2021) for i in range(6)]
    for n in range(3):
        part = "".join(f"{y},{i},{v}\n" for y, i, v in lines[n::3] + lines[:2])
        (source / f"f{n}.csv").write_text("Year,id,v\n" + part)
    schema = spark.createDataFrame([], RAW).schema
    clean = lambda df: df.withColumn("v", F.upper("v"))

    def run(checkpoint):
        append_stream(
            spark, str(source), schema, clean, path, ["Year", "id"], "Year", str(tmp_path / checkpoint), files_per_batch=1
        ).awaitTermination()
        return rows(spark.read.schema(RAW).parquet(path), "Year", "id", "v")

    want = sorted((y, str(i), v.upper()) for y, i, v in lines)
    assert run("c1") == want
    assert run("c1") == want
    assert run("c2") == want


def test_stream_refuses_a_changed_header(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("id,Year,v\n1,2020,x\n")
    query = append_stream(
        spark, str(source), spark.createDataFrame([], RAW).schema, lambda df: df, str(tmp_path / "t"), ["Year", "id"], "Year", str(tmp_path / "c")
    )
    with pytest.raises(Exception):
        query.awaitTermination()


def test_half_written_cache_is_built_again(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(5).write.parquet(path)
    (tmp_path / "table" / "_SUCCESS").unlink()
    assert sinks.read_or_build(spark, path, lambda: spark.range(7)).count() == 7
    with pytest.raises(ValueError):
        sinks.read_or_build(spark, "", lambda: spark.range(1))


def test_append_needs_the_partition_in_the_key(spark, tmp_path):
    batch = spark.createDataFrame([(1, 2020)], "id int, Year int")
    with pytest.raises(ValueError):
        append_new(batch, str(tmp_path / "t"), ["id"], "Year")


def test_titled_table_keeps_every_record(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('A title, with a comma\nid,note,c,c\n1,"two\nlines",A,x\n2,"he said ""hi, you"" ok",  B  ,NA\nid,note,c,c\n3,,"a ""q"", b",\n')
    found = readers.read_titled_csv(spark, str(path))
    assert [tuple(r) for r in found.collect()] == [
        ("1", "two\nlines", "A", "x"), ("2", 'he said "hi, you" ok', "B", "NA"), ("id", "note", "c", "c"), ("3", None, 'a "q", b', None),
    ]
    plain = tmp_path / "e" / "metabase_1.csv"
    plain.parent.mkdir()
    plain.write_text('a,b\n1,NA\n"x\ny",""\n')
    assert [tuple(r) for r in readers.read_extracts(spark, str(plain.parent)).collect()] == [("1", None, 2020), ("x\ny", None, 2020)]


def test_a_writer_that_stops_leaves_the_earlier_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old = sinks.read_or_build(spark, path, lambda: spark.range(3))

    def stop(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(versions, "_point", stop)  # the data are written, the pointer is not
        with pytest.raises(KeyboardInterrupt):
            sinks.read_or_build(spark, path, lambda: spark.range(9), refresh=True)
    assert sinks.read_or_build(spark, path, lambda: spark.range(99)).count() == 3 and old.count() == 3
    with monkeypatch.context() as broken:
        broken.setattr(sinks, "write_table", stop)
        with pytest.raises(KeyboardInterrupt):
            sinks.read_or_build(spark, path, lambda: spark.range(9), refresh=True)
    assert sinks.read_or_build(spark, path, lambda: spark.range(99)).count() == 3
    assert sinks.read_or_build(spark, path, lambda: spark.range(4), refresh=True).count() == 4
    assert old.count() == 3  # a plan on the version before still reads it
    assert len(versions.sweep(spark, path, older_than=3600)) == 0
    assert len(versions.sweep(spark, path, older_than=0)) == 1 and old.count() == 3


def test_versions_are_retired_and_a_plain_table_is_superseded(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)
    assert sinks.read_or_build(spark, path, lambda: spark.range(9)).count() == 2
    for n in (3, 4, 5):
        assert sinks.read_or_build(spark, path, lambda n=n: spark.range(n), refresh=True).count() == n
    assert len(versions.published(spark, path)) == 2
    assert versions.children(spark, path) == ["_published", "versions"]
    first = versions.publish(spark, path, lambda folder: spark.range(6).write.parquet(folder))
    assert versions.current(spark, path) == first and spark.read.parquet(first).count() == 6


def _table(spark, path):
    return rows(spark.read.schema(RAW).parquet(path), "Year", "id", "v")


def test_a_replayed_batch_reads_neither_table_nor_digests(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    batches = [spark.createDataFrame([(y, str(i), f"v{i}") for i in range(a, a + 40)], RAW) for y, a in ((2020, 0), (2021, 0), (2020, 20))]
    assert [append_new(b, path, ["Year", "id"], "Year") for b in batches] == [True, True, True]
    want = _table(spark, path)
    assert len(want) == 100

    def refuse(*_):
        raise AssertionError("stored keys were read")

    monkeypatch.setattr(append, "_stored", refuse)
    monkeypatch.setattr(ledger.Ledger, "keys", refuse)
    assert [append_new(b, path, ["Year", "id"], "Year") for b in batches] == [False, False, False]
    assert _table(spark, path) == want


def test_new_keys_are_known_to_be_new_by_the_filter(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append_new(spark.createDataFrame([(2020, str(i), "a") for i in range(300)], RAW), path, ["Year", "id"], "Year")
    met = []
    real = ledger.Ledger.seen

    def seen(self, fresh, touched):
        out = real(self, fresh, touched)
        met.append(None if out is None else out.count())
        return out

    monkeypatch.setattr(ledger.Ledger, "seen", seen)
    append_new(spark.createDataFrame([(2021, str(i), "a") for i in range(50)], RAW), path, ["Year", "id"], "Year")
    append_new(spark.createDataFrame([(2020, str(i), "b") for i in range(290, 310)], RAW), path, ["Year", "id"], "Year")
    assert met == [None, 10]
    assert len(_table(spark, path)) == 360


@pytest.mark.parametrize("step", ["data", "keys", "filter", "finish"])
def test_an_interrupted_batch_is_made_good(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    early = spark.createDataFrame([(2020, str(i), "a") for i in range(30)], RAW)
    late = spark.createDataFrame([(y, str(i), "b") for y in (2020, 2021, None) for i in range(20, 40)], RAW)
    append_new(early, path, ["Year", "id"], "Year")

    def stop(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        if step == "data":
            broken.setattr(ledger.Ledger, "enter", stop)
        elif step == "finish":
            broken.setattr(ledger.Ledger, "finish", stop)
        else:
            real = ledger.Ledger._write
            broken.setattr(ledger.Ledger, "_write", lambda self, df, name, replace: stop() if name == step else real(self, df, name, replace))
        with pytest.raises(KeyboardInterrupt):
            append_new(late, path, ["Year", "id"], "Year")
    want = _table(spark, path)
    assert len(want) == 80
    append_new(late, path, ["Year", "id"], "Year")
    append_new(spark.createDataFrame([(2021, "21", "c"), (2020, "39", "c"), (None, "20", "c"), (2022, "1", "c")], RAW), path, ["Year", "id"], "Year")
    assert _table(spark, path) == sorted([*want, (2022, "1", "c")], key=lambda t: tuple((v is None, str(v)) for v in t))
    assert ledger.Ledger(spark, path, "Year", "int").interrupted() == {}


def test_a_table_without_a_ledger_gets_one(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(2020, "1", "a"), (2021, "2", "a")], RAW).write.partitionBy("Year").parquet(path)
    append_new(spark.createDataFrame([(2020, "1", "b"), (2020, "3", "b")], RAW), path, ["Year", "id"], "Year")
    assert _table(spark, path) == [(2020, "1", "a"), (2020, "3", "b"), (2021, "2", "a")]


def test_filters_grow_with_their_partition(spark, tmp_path):
    book = ledger.Ledger(spark, str(tmp_path / "t"), "Year", "int")
    d1, d2 = ledger.digests(["Year", "id"])
    keyed = lambda a, b: spark.range(a, b).select(F.lit(2020).alias("Year"), F.col("id").cast("string").alias("id")).select("Year", d1.alias("__d1"), d2.alias("__d2"))
    book.enter(keyed(0, 100), [2020])
    book.enter(keyed(100, 5000), [2020])
    sizes = {r[0] for r in book.filter([2020]).select("__size").collect()}
    assert sizes == {11}
    assert book.seen(keyed(4000, 5000), [2020]).count() == 1000
    other = book.seen(keyed(10_000, 20_000), [2020])
    assert other is None or other.count() == 0
    missing = spark.createDataFrame([(None, "1"), (2020, None), (None, None)], "Year int, id string").select(d1.alias("a"), d2.alias("b"))
    assert len({tuple(r) for r in missing.collect()}) == 3


def test_a_run_from_options_does_only_what_changed(spark, tmp_path, monkeypatch):
    from fieldprep.plans import options as plan

    raw, kept, layers, out = (tmp_path / n for n in ("raw", "kept", "layers", "out"))
    (kept / "fouled").mkdir(parents=True)
    for folder, names in ((raw, [f"{y}.csv" for y in range(2015, 2020)]), (kept, [f"{n}.csv" for n in (*plan.PREPARING, "gazetteer")]), (layers, [*plan.REPORTING, *plan.WATERS])):
        folder.mkdir(exist_ok=True)
        for name in names:
            (folder / name).write_text("x\n")
    path = tmp_path / "options.csv"
    told = lambda year: path.write_text(f"base_dir,operations_folder,year,spatial_folder,figure_folder,figure_output_folder\n{raw},{kept},{year},{layers},{tmp_path},{out}\n")
    told(2020)
    did = []
    monkeypatch.setattr(plan.Inputs, "sources", lambda self: None)
    monkeypatch.setattr(plan.Inputs, "lookups", lambda self: None)
    monkeypatch.setattr(plan.Inputs, "layers", lambda self: None)
    monkeypatch.setattr(plan, "_without_waters", lambda given: None)
    for name in ("prepare_inspections", "make_reports", "make_polygon_summaries"):
        monkeypatch.setattr(plan, name, lambda *_, name=name: did.append(name))

    def run():
        did.clear()
        ran = plan.run_from_options(spark, str(path))
        assert len(did) == sum(ran.values())
        return [s for s, now in ran.items() if now]

    assert run() == ["prepare", "reports", "polygons"]
    assert run() == []
    (layers / "rivers").write_text("longer\n")
    assert run() == ["polygons"]
    told(2021)
    assert run() == ["reports", "polygons"]
    (kept / "fouled" / "2017.csv").write_text("a list\n")
    assert run() == ["prepare", "reports", "polygons"]

    def stop(*_):
        raise KeyboardInterrupt

    (layers / "states").write_text("longer\n")
    with monkeypatch.context() as broken:
        broken.setattr(plan, "make_reports", stop)
        with pytest.raises(KeyboardInterrupt):
            run()
    assert run() == ["reports", "polygons"]
    (raw / "2016.csv").unlink()
    with pytest.raises(ValueError):
        run()
