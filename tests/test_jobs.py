"""CSV source and the jobs from file to file."""

import os

import pytest
from pyspark.sql import functions as F

from tabulyst.config import TrainConfig
from tabulyst.plans.eda import profile
from tabulyst.plans.listing import listing
from tabulyst.plans import queries
from tabulyst.plans.predict import predict, predict_frame
from tabulyst.plans.report import report_tables
from tabulyst.plans.train import load_artifact, train
from tabulyst.roles import ORDER_LISTING
from tabulyst.functions.text import NUMBER, SPACES, finite, parse_money, parse_number, strip
from tabulyst.operators import ordering
from tabulyst.scratch import materialize
from tabulyst.sources import csv as csv_source
from tabulyst.sources.csv import POSITION, drop_duplicates, read_csv, training_rows
from tabulyst.sources.demo import make_listings, write_listings
from tabulyst.sources.sinks import read_json, table_fingerprint, write_csv, write_json
from tabulyst.streaming.score import score_stream

CONFIG = TrainConfig(models=("ridge",), feature_sets=("engineered",), cv_folds=2)


def test_csv_source(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes('﻿ Id ,x\n007,NA\n008,""\n009,None\n010, 5\n'.encode())
    rows = read_csv(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("007", None), ("008", None), ("009", None), ("010", " 5")]
    placed = read_csv(spark, str(path), position=True).orderBy(POSITION).collect()
    assert [(r["Id"], r[POSITION]) for r in placed] == [("007", 0), ("008", 1), ("009", 2), ("010", 3)]
    for text in ("a,a\n1,2\n", "a,A\n1,2\n", "a,\n1,2\n", "a,b\n", "a,b\n1,2,3\n", 'a,b\n"1,5",2,\n'):
        path.write_text(text)
        with pytest.raises(ValueError):
            read_csv(spark, str(path))
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "a.txt"))


def test_csv_keeps_every_character(spark, tmp_path):
    ids = [" 007", 'a"b', "c,d", "two\nlines", "e\\f", "  ", "007 "]
    path = str(tmp_path / "out.csv")
    write_csv(spark.createDataFrame([(x, str(i)) for i, x in enumerate(ids)], "Id string, n string").coalesce(1), path)
    rows = read_csv(spark, path, position=True).orderBy(POSITION).collect()
    assert [r["Id"] for r in rows] == ids and [r["n"] for r in rows] == [str(i) for i in range(len(ids))]


def test_csv_folder_goes_by_file(spark, tmp_path):
    folder = tmp_path / "parts.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n" + "".join(f"a{i},1\n" for i in range(3)))
    (folder / "b.csv").write_text("x,y\n" + "".join(f"b{i}\n" for i in range(50)))
    rows = read_csv(spark, str(folder), position=True).orderBy(POSITION).collect()
    assert [r["x"] for r in rows] == [f"a{i}" for i in range(3)] + [f"b{i}" for i in range(50)]
    assert [r[POSITION] for r in rows] == list(range(53)) and rows[-1]["y"] is None
    (folder / "c.csv").write_text("y,x\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(folder)).collect()


def test_duplicates_keep_the_first_position(spark):
    df = spark.createDataFrame([(1, None, 0), (1, None, 3), (2, "a", 1)], "a int, b string, p long")
    assert sorted(tuple(r) for r in drop_duplicates(df, "p").collect()) == [(1, None, 0), (2, "a", 1)]
    plain = df.select("a", "b")
    assert table_fingerprint(plain).first() == table_fingerprint(plain.repartition(3)).first()
    assert table_fingerprint(plain).first() != table_fingerprint(plain.distinct()).first()


def test_invalid_training_rows(spark):
    frame = make_listings(spark, 100)
    first = F.col("Id") == "000001"
    bad = [
        frame.withColumn("Id", F.when(first, "000002").otherwise(F.col("Id"))),
        frame.withColumn("Id", F.when(first, " ").otherwise(F.col("Id"))),
        frame.withColumn("SalePrice", F.when(first, -1.0).otherwise(F.col("SalePrice"))),
        frame.withColumn("SalePrice", F.when(first, float("nan")).otherwise(F.col("SalePrice"))),
        frame.drop("LotArea"), frame.drop("SalePrice"), frame.limit(79),
    ]
    for df in bad:
        with pytest.raises(ValueError):
            training_rows(df)
    with pytest.raises(ValueError):
        training_rows(frame.drop("Id"))
    text = frame.withColumn("LotArea", F.col("LotArea").cast("string"))
    again = text.limit(5).withColumn("LotArea", F.concat("LotArea", F.lit(" ")))
    assert training_rows(text.unionByName(again))[1]["duplicates_removed"] == 5
    rows, summary = training_rows(frame.unionByName(frame.limit(5)))
    assert summary == {"rows_loaded": 105, "duplicates_removed": 5, "usable_rows": 100}


def test_training_rows_are_not_written_twice(spark, tmp_path, monkeypatch):
    """Rows that were written with their positions are read from there."""
    written = []

    def counting(stage):
        out = materialize(stage)
        written.append(out.count())
        return out

    monkeypatch.setattr(csv_source, "materialize", counting)
    monkeypatch.setattr(ordering, "materialize", counting)
    frame = make_listings(spark, 200)
    path = str(tmp_path / "rows.csv")
    write_csv(frame, path)
    for source in (read_csv(spark, path, position=True), frame):
        found, summary = training_rows(source)
        assert summary["usable_rows"] == 200
        assert sorted(r[0] for r in found.select(POSITION).collect()) == list(range(200))
        assert sum(n >= 200 for n in written) == 2
        written.clear()


def test_plain_texts_are_values_without_trimming(spark):
    """The short way for plain texts gives what trimming, the pattern and the cast give."""
    texts = ["12", "-0", ".5", "5.", "1e99", "1E400", "9" * 101, "9" * 400, "12\n", "12\u0085", "\u00a05", "1e5 ", "1,5", "$12", "", " ",
             "a b", "a b ", "\u00e4", "a\x1f", "a\n", "1d", "+1e-99", "1e", "-", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    bare = F.btrim("t", F.lit(SPACES))
    number = F.when(bare.rlike(NUMBER), bare.try_cast("double"))
    money = F.btrim(F.regexp_replace("t", "[$,]", ""), F.lit(SPACES))
    paid = F.when(money.rlike(NUMBER), money.try_cast("double"))
    row = df.select(
        F.count_if(~strip(F.col("t")).eqNullSafe(bare)),
        F.count_if(~parse_number(F.col("t")).eqNullSafe(finite(number))),
        F.count_if(~parse_money(F.col("t")).eqNullSafe(finite(paid))),
        F.count(parse_number(F.col("t"))),
    ).first()
    assert list(row) == [0, 0, 0, 11]


def test_strict_json(spark, tmp_path):
    with pytest.raises(ValueError):
        write_json(spark, {"a": float("nan")}, str(tmp_path / "x"))
    write_json(spark, {"a": [1, None]}, str(tmp_path / "y"))
    assert read_json(spark, str(tmp_path / "y")) == {"a": [1, None]}


def test_jobs_from_file_to_file(spark, tmp_path):
    data, run = str(tmp_path / "demo.csv"), str(tmp_path / "run")
    write_listings(spark, data, 120)
    with pytest.raises(FileExistsError):
        write_listings(spark, data, 120)
    tables = profile(spark, data, str(tmp_path / "eda"))
    assert tables["numeric_correlations"].count() == 36 * 36
    assert read_json(spark, str(tmp_path / "eda/summary.json"))["usable_rows"] == 120
    result = train(spark, data, run, CONFIG)
    meta = result["metadata"]
    assert meta["partitions"] == {"train": 76, "validation": 20, "holdout": 24}
    assert meta["metrics"]["holdout"]["rows"] == 24
    parts = spark.read.parquet(f"{run}/split_assignments")
    assert parts.select(POSITION).distinct().count() == 120
    assert spark.read.parquet(f"{run}/holdout_price_deciles").agg(F.sum("rows")).first()[0] == 24
    assert {t.count() for t in report_tables(spark, run).values()} == {5, 21, 2}
    with pytest.raises(FileExistsError):
        train(spark, data, run, CONFIG)

    model, _ = load_artifact(spark, result["model_path"])
    raw = read_csv(spark, data).where("Id <= '000005'")
    raw = raw.withColumn("Neighborhood", F.when(F.col("Id") == "000001", "New").otherwise(F.col("Neighborhood")))

    def prices(frame):
        return {r["Id"]: r["SalePrice"] for r in predict_frame(model, frame).collect()}

    expected = prices(raw)
    assert sorted(expected) == [f"00000{i}" for i in range(1, 6)]
    assert prices(raw.select(*reversed(raw.columns))) == pytest.approx(expected)
    assert prices(raw.withColumn("SalePrice", F.lit("1e10"))) == pytest.approx(expected)
    with pytest.raises(ValueError, match="Missing required"):
        predict_frame(model, raw.drop("Neighborhood"))

    out = str(tmp_path / "scored.csv")
    predict(spark, result["model_path"], raw, out)
    saved = read_csv(spark, out)
    assert saved.columns == ["Id", "SalePrice"] and saved.count() == 5
    assert read_json(spark, str(tmp_path / "scored.metrics.json"))["rows"] == 5
    predict(spark, result["model_path"], raw.drop("SalePrice"), str(tmp_path / "bare.csv"))
    assert not os.path.exists(tmp_path / "bare.metrics.json")
    with pytest.raises(FileExistsError):
        predict(spark, result["model_path"], raw, out)

    source = str(tmp_path / "stream")
    raw.drop("SalePrice").write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    query = score_stream(model, stream, str(tmp_path / "live"), str(tmp_path / "marks"), availableNow=True)
    query.awaitTermination(120)
    live = {r["Id"]: r["SalePrice"] for r in spark.read.parquet(str(tmp_path / "live")).collect()}
    assert live == pytest.approx(expected)


def test_holdout_labels_change_nothing_but_holdout_metrics(spark, tmp_path):
    frame = listing(spark, "/root/testdata/sf0.001").where("cast(id as int) < 100").cache()
    config = TrainConfig(
        models=("ridge",), feature_sets=("original",), target_transforms=("raw",), encoding="onehot",
        cv_folds=2, search_iterations=2,
    )
    first = train(spark, frame, str(tmp_path / "a"), config, ORDER_LISTING)
    assert spark.read.parquet(str(tmp_path / "a/search_ridge__original__raw")).count() == 12
    held = spark.read.parquet(str(tmp_path / "a/split_assignments")).where("partition = 'holdout'")
    held = [r["id"] for r in held.collect()]
    assert len(held) == 20
    changed = frame.withColumn(
        "label", F.when(F.col("id").isin(held), F.col("label") * 5).otherwise(F.col("label"))
    )
    second = train(spark, changed, str(tmp_path / "b"), config, ORDER_LISTING)
    a, b = first["metadata"], second["metadata"]
    assert a["selected_model"] == b["selected_model"]
    assert a["smearing_factor"] == b["smearing_factor"] == 1.0
    assert a["metrics"]["validation"] == pytest.approx(b["metrics"]["validation"], rel=1e-9)
    assert a["metrics"]["holdout"] != b["metrics"]["holdout"]
    scored = [
        {
            r["id"]: r["label"]
            for r in predict_frame(
                load_artifact(spark, m["model_path"], ORDER_LISTING)[0], frame.limit(5)
            ).collect()
        }
        for m in (first, second)
    ]
    assert scored[0] == pytest.approx(scored[1], rel=1e-9)


@pytest.mark.parametrize("name", ["train_job", "predict_job"])
def test_registered_jobs_compare_the_default_candidates(spark, monkeypatch, name):
    given = []

    def stop(spark, frame, run, config, roles):
        given.append(config)
        raise InterruptedError

    monkeypatch.setattr(queries, "train", stop)
    with pytest.raises(InterruptedError):
        queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert given == [TrainConfig()]
