"""Column documents in pieces give the rows of the whole-file reader, wherever the pieces are cut."""

import json
import random

import pytest

from sensorwatch.schemas import table
from sensorwatch.sources import files
from sensorwatch.sources.documents import read_column_documents_in_pieces

SCHEMA = table("year int, v double, note string")


@pytest.fixture
def pieces(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield cut
    for n, v in old.items():
        spark.conf.set(n, v)


def rows(df):
    return sorted((r["source_file"], r["source_index"], r["year"], r["v"], r["note"]) for r in df.collect())


def document(seed, n):
    rng = random.Random(seed)
    texts = ["a,b", 'say "x", then', "{}", "},{", "back\\slash,", "", "ü,é", "line\nbreak", '"', '\\"', "plain"]
    return {
        "year": {str(i): rng.choice([2020, 2021, None]) for i in range(n)}, "odd, name": {str(i): i for i in range(3)},
        "note": {str(i): rng.choice(texts) for i in range(n) if i % 4}, "empty": {}, "v": {str(i): rng.choice([1.5, -2e-3, None]) for i in range(0, n, 2)},
    }


@pytest.mark.parametrize("size", [150, 333, 1 << 20])
def test_pieces_equal_the_whole(spark, folder, pieces, size):
    for name, (seed, n, indent) in {"a": (1, 40, None), "b": (2, 25, 1), "c": (3, 0, None)}.items():
        with open(f"{folder}/{name}.json", "w", encoding="utf-8") as out:
            json.dump(document(seed, n) if n else {}, out, indent=indent, ensure_ascii=seed == 1)
    wanted = rows(files.read_column_documents(spark, folder, SCHEMA))
    pieces(size)
    found = read_column_documents_in_pieces(spark, folder, SCHEMA)
    assert rows(found) == wanted and len(wanted) >= 60


def test_a_large_document_is_read_by_many_tasks(spark, folder, pieces):
    n = 60_000
    with open(f"{folder}/large.json", "w") as out:
        json.dump({"year": {str(i): 2000 + i % 20 for i in range(n)}, "v": {str(i): i / 4 for i in range(n)}, "note": {str(i): f"x,{i}" for i in range(n)}}, out)
    pieces(200_000)
    assert spark.read.option("lineSep", ",").text(folder).rdd.getNumPartitions() > 8
    found = read_column_documents_in_pieces(spark, folder, SCHEMA)
    assert found.filter("year = 2000 + source_index % 20 and v = source_index / 4 and note = concat('x,', source_index)").count() == n


def test_other_documents_are_refused(spark, folder):
    with open(f"{folder}/x.json", "w") as out:
        out.write('{"v": {"0": [1, 2]}}')
    with pytest.raises(Exception, match="not a cell"):
        read_column_documents_in_pieces(spark, folder, SCHEMA).collect()
