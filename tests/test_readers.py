import json

import pytest

from flowwarden.schemas import TRAINING_LABELS
from flowwarden.session import work_path
from flowwarden.sources import readers


def sidecar(spark, tmp_path, doc):
    path = tmp_path / "labels.json"
    path.write_text(json.dumps(doc, indent=2))
    return {r.attack_cat_id: r.attack_type for r in readers.read_label_map(spark, str(path)).collect()}


def test_label_map_layouts(spark, tmp_path):
    assert sidecar(spark, tmp_path, {"reverse_mapping": {"0": "Normal", "x": "skipped", "3": "DoS"}}) == {0: "Normal", 3: "DoS"}
    names = sidecar(spark, tmp_path, {"attack_mapping": TRAINING_LABELS})
    assert len(names) == 10 and names[3] == "Backdoor" and names[9] == "Worms"
    assert sidecar(spark, tmp_path, {"0": "Normal", "x": "skipped", "1": "DoS"}) == {0: "Normal", 1: "DoS"}
    assert sidecar(spark, tmp_path, {}) == {}


def test_written_sidecars_read_back(spark):
    for layout in ("both", "plain"):
        path = work_path(spark, layout)
        readers.write_label_map(spark, path, {"Normal": 0, "DoS": 4}, layout)
        assert {r.attack_cat_id: r.attack_type for r in readers.read_label_map(spark, path).collect()} == {0: "Normal", 4: "DoS"}
    path = work_path(spark, "results")
    readers.write_results(spark, path, {"forest": ({"numTrees": 3}, {"accuracy": 0.5})})
    assert readers.read_results(spark, path).first().asDict() == {"model": "forest", "params": {"numTrees": "3"}, "metrics": {"accuracy": 0.5}}


def test_feature_list(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps({"features": ["b", "a"], "num_features": 2}, indent=1))
    rows = readers.read_feature_list(spark, str(tmp_path / "f.json")).orderBy("position").collect()
    assert [r.feature for r in rows] == ["b", "a"]


def test_first_pattern_with_files_wins(spark):
    path = work_path(spark, "csv")
    spark.range(3).coalesce(1).write.option("header", True).csv(f"{path}/a")
    assert readers.read_flow_files(spark, path, ["none_*.csv", "part-*.csv"], "id bigint").count() == 3
    assert readers.read_flow_files(spark, path, ["part-*.csv"]).schema["id"].dataType.simpleString() == "int"
    with pytest.raises(FileNotFoundError, match="none_"):
        readers.read_flow_files(spark, path, ["none_*.csv"])


def test_csv_with_inferred_types(spark):
    path = work_path(spark, "csv")
    spark.createDataFrame([(1, 2.5, "x")], "a int, b double, c string").write.option("header", True).csv(path)
    assert [f.dataType.simpleString() for f in readers.read_csv(spark, path).schema] == ["int", "double", "string"]
