import re

import pytest
from pyspark.sql import functions as F

from claimweave.llm import licences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return licences.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy(model):
    assert model.accuracy >= 0.95 and 0.5 <= model.least < 1


def test_given_documents(spark, model):
    """Every licence line of the documents is found with its family, and nothing else."""
    families = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC"}
    total = 0
    for r in licences.find_licences(spark.read.parquet(f"{SF}/documents.parquet"), model).collect():
        raw = r["text"].encode()
        want = [f for line in raw.decode().split("\n") for t, f in families.items() if t in line]
        got = [x["family"] for x in r["licences"]]
        assert got == want, r["doc_id"]
        assert all(re.search("(?i)licen", raw[x["start"] : x["end"]].decode()) for x in r["licences"])
        total += len(got)
    assert total > 30


def test_odd_texts(spark, model):
    texts = [None, "", "\n\n", "x", "licence", "The license was under the version.", "one\nReleased under the MIT License.\nlast", "Released under the MIT License.", "é\n  Licensed under CC BY-SA 4.0.", "under the license " * 3000]
    frame = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, licences int").repartition(3)
    got = {r["doc_id"]: [(x["family"], x["start"]) for x in r["licences_"]] for r in licences.find_licences(frame, model).collect()}
    assert got == {**{k: [] for k in range(10)}, 6: [("MIT", 4)], 7: [("MIT", 0)], 8: [("CC-BY-SA", 3)]}
    assert licences.find_licences(frame.limit(0), model).count() == 0
    assert licences.train(frame.limit(0)).accuracy > 0.9
    for family, notices in licences.TEMPLATES.items():
        assert all(x[0] in (family, licences.UNKNOWN) for x in model.predict(list(notices)))
        assert any(x[0] == family for x in model.predict(list(notices)))
