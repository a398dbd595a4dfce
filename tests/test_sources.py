import json

import pytest

from hourlake import schemas
from hourlake.sources import publish, readers, writers

CITY = {"city_id": 904, "city": "Łąka", "country": "Øst", "latitude": -33.0, "longitude": 0.5}


def configuration(tmp_path, content):
    path = tmp_path / "cities.json"
    path.write_text(json.dumps(content, indent=2), encoding="utf-8")
    return str(path)


def test_cities_are_read_across_lines(spark, tmp_path):
    listed = [CITY | {"city_id": n, "city": "zwei\nZeilen" * (n % 2)} for n in range(5)]
    path = configuration(tmp_path, listed)
    assert [r.asDict() for r in readers.read_cities(spark, path).collect()] == listed


@pytest.mark.parametrize(
    "content, message",
    [
        ([], "City configuration list must not be empty"),
        (CITY, "City configuration must be a list"),
        (None, "City configuration must be a list"),
        (904, "City configuration must be a list"),
    ],
)
def test_wrong_configurations_are_refused(spark, tmp_path, content, message):
    with pytest.raises(ValueError, match=message):
        readers.read_cities(spark, configuration(tmp_path, content))


def test_documents_from_json_lines(spark, tmp_path):
    document = {
        "run_id": "r1",
        "city": {"city_id": 904, "city": "Łąka"},
        "ingestion_metadata": {"ingested_at_utc": "2035-04-01T21:30:00Z"},
        "raw_payload": {"hourly": {"time": ["whenever"], "pm10": [8], "other": [1]}},
    }
    path = tmp_path / "documents.json"
    path.write_text(json.dumps(document))
    row = readers.read_documents(spark, str(path), fmt="json").first()
    assert row["raw_payload"]["hourly"]["pm10"] == [8.0]
    assert row["raw_payload"]["hourly"]["pm2_5"] is None
    assert str(row["ingestion_metadata"]["ingested_at_utc"]) == "2035-04-01 21:30:00"


def test_source_profile(spark):
    frame = spark.createDataFrame([(1, ["x"]), (2, None)], "id INT, tags ARRAY<STRING>")
    rows = [tuple(r) for r in readers.source_profile(frame).orderBy("position").collect()]
    assert rows == [(2, 0, "id", "int"), (2, 1, "tags", "array<string>")]


def stored(spark, path):
    return sorted(r["id"] for r in readers.read_table(spark, path, "id BIGINT").collect())


def test_replacing_a_table_keeps_the_old_one_until_the_check_passes(spark, tmp_path):
    path = str(tmp_path / "table")

    def refuse(staging):
        assert spark.read.parquet(staging).count() == 3
        raise RuntimeError("not good enough")

    writers.replace_table(spark.range(2), path, lambda staging: None)
    assert stored(spark, path) == [0, 1]
    with pytest.raises(RuntimeError, match="not good enough") as refused:
        writers.replace_table(spark.range(3), path, refuse)
    assert "rejected rows are kept in" in refused.value.__notes__[0]
    assert stored(spark, path) == [0, 1]
    writers.replace_table(spark.range(4), path, lambda staging: None)
    assert stored(spark, path) == [0, 1, 2, 3]


def test_old_table_is_read_whole_whatever_step_a_writer_stops_at(spark, tmp_path, monkeypatch):
    """Each file that publishing creates may be the last one; only the last of all changes the table."""
    path = str(tmp_path / "table")
    writers.replace_table(spark.range(2), path, lambda staging: None)
    real = publish.file_system

    def stopping_at(step):
        left = [step]

        def file_system(session, location):
            files, found = real(session, location)

            class Files:
                def __getattr__(self, name):
                    return getattr(files, name)

                def createNewFile(self, target):
                    left[0] -= 1
                    if left[0] < 0:
                        raise KeyboardInterrupt
                    return files.createNewFile(target)

            return Files(), found

        return file_system

    for step in range(3):
        with monkeypatch.context() as patch:
            patch.setattr(publish, "file_system", stopping_at(step))
            with pytest.raises(KeyboardInterrupt):
                writers.replace_table(spark.range(3), path, lambda staging: None)
        assert stored(spark, path) == [0, 1]
    frame = readers.read_table(spark, path, "id BIGINT")
    writers.replace_table(spark.range(5), path, lambda staging: None)
    assert stored(spark, path) == [0, 1, 2, 3, 4]
    # Who began to read before goes on reading the old rows, which clean_up leaves them at first.
    assert len(publish.clean_up(spark, path, keep=2, older_than=0)) == 3
    assert frame.count() == 2 and stored(spark, path) == [0, 1, 2, 3, 4]
    assert len(publish.clean_up(spark, path, keep=1, older_than=0)) == 1
    assert stored(spark, path) == [0, 1, 2, 3, 4]
    writers.replace_table(spark.range(1), path, lambda staging: None)
    assert stored(spark, path) == [0]


def test_a_folder_of_plain_files_is_read_but_not_turned_into_a_table(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.range(2).write.parquet(path)
    assert stored(spark, path) == [0, 1]
    with pytest.raises(FileExistsError, match="aren't a published table's"):
        writers.replace_table(spark.range(3), path, lambda staging: None)
    assert stored(spark, path) == [0, 1]


def test_several_keys_change_at_once_and_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "table")
    first, second, again = (writers.Batch(path, k) for k in ("a", "b", "a"))
    for batch, count in ((first, 1), (second, 2), (again, 3)):
        batch.write(spark.range(count))
    with pytest.raises(FileNotFoundError):
        stored(spark, path)
    publish.publish(spark, path, {"a": first.folder, "b": second.folder})
    assert stored(spark, path) == [0, 0, 1]
    again.publish(spark)
    assert stored(spark, path) == [0, 0, 1, 1, 2]
    with pytest.raises(ValueError, match="can't be part of a file name"):
        publish.publish(spark, path, {"a.b": first.folder})
    assert stored(spark, path) == [0, 0, 1, 1, 2]


def test_work_folder_is_the_clusters_shared_folder_where_one_is_named(spark, monkeypatch):
    named = {"spark.checkpoint.dir": "hdfs://shared/work", "spark.sql.warehouse.dir": "s3a://house"}
    conf = type("Conf", (), {"get": lambda self, k, d=None: named.get(k, d)})()
    session = type("Session", (), {"conf": conf})()
    assert writers.work_folder(session).startswith("hdfs://shared/work/hourlake-")
    assert writers.work_folder(session) != writers.work_folder(session)
    del named["spark.checkpoint.dir"]
    assert writers.work_folder(session).startswith("s3a://house/hourlake-")


def test_schemas_have_the_persisted_columns():
    assert len(schemas.silver()) == 18
    assert len(schemas.gold()) == 21
