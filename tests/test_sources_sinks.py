import json
import os
import tempfile

import pytest

from chatsift.sinks.writers import (
    append_jsonl, empty_chat, publish, read_release, release_manifest, write_json_report, write_split,
)
from chatsift.sources.datasets import (
    load_config, load_split, pick_split, read_done_ids, read_jsonl_strict, require_columns,
)
from chatsift.sources.fixtures import messages_from_turns


def test_split_roundtrip_and_pick(spark):
    root = tempfile.mkdtemp(prefix="cs-split-")
    write_split(empty_chat(spark), root, "train")
    back = load_split(spark, root, "train")
    assert back.count() == 0 and back.columns == ["id", "messages"]
    write_split(spark.range(3), root, "alpha")
    assert pick_split(spark, root) == "train"
    other = tempfile.mkdtemp(prefix="cs-split-")
    write_split(spark.range(3), other, "beta")
    write_split(spark.range(2), other, "alpha")
    assert pick_split(spark, other) == "alpha"
    assert load_split(spark, f"{other}/beta", "ignored").count() == 3


def test_done_ids_lenient(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="cs-done-"), "g.jsonl")
    with open(path, "w") as fh:
        fh.write('{"id": 1}\n\n{"id": 2, "x"\n{"other": 3}\n{"id": "a"}\n{"id": 1}\n')
    assert sorted(r.id for r in read_done_ids(spark, path).collect()) == ["1", "a"]
    assert read_done_ids(spark, path + ".missing").count() == 0


def test_jsonl_strict_fails_on_bad_line(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="cs-strict-"), "g.jsonl")
    with open(path, "w") as fh:
        fh.write('{"id": 1}\n{"id": \n')
    with pytest.raises(Exception):
        read_jsonl_strict(spark, path, "id long").collect()


def test_append_jsonl_keeps_non_ascii(spark):
    path = tempfile.mkdtemp(prefix="cs-app-") + "/out"
    df = spark.createDataFrame([(1, "é à"), (2, None)], "id long, t string")
    append_jsonl(df, path)
    append_jsonl(df, path)
    back = spark.read.json(path)
    assert back.count() == 4 and {r.t for r in back.collect()} == {"é à", None}
    raw = "".join(open(os.path.join(path, f), encoding="utf-8").read() for f in os.listdir(path) if f.endswith(".json"))
    assert "é à" in raw


def test_publish_and_report(spark):
    root = tempfile.mkdtemp(prefix="cs-pub-")
    out = publish(spark.range(4), root, "rel")
    assert spark.read.parquet(out["parquet"]).count() == 4
    assert spark.read.json(out["jsonl"]).count() == 4
    first = release_manifest(spark, root, "rel")
    assert first == out and read_release(spark, root, "rel").count() == 4
    publish(spark.range(5), root, "rel")
    assert read_release(spark, root, "rel").count() == 5 and spark.read.parquet(first["parquet"]).count() == 4


@pytest.mark.parametrize("parts", [0, 1, 7, 40])
def test_json_report_is_one_array_of_all_parts(spark, parts):
    path = os.path.join(tempfile.mkdtemp(prefix="cs-rep-"), "deep", "r.json")
    rows = [{"id": i, "text": f'é "{i}"\n', "none": None, "turns": [{"role": "user", "n": i / 2}]} for i in range(3 * parts // 2)]
    schema = "id long, text string, none string, turns array<struct<role:string,n:double>>"
    df = spark.createDataFrame([(r["id"], r["text"], None, [("user", r["id"] / 2)]) for r in rows], schema)
    if parts > 1:
        df = df.repartitionByRange(parts, "id")  # some parts are empty
    for _ in range(2):  # the second one replaces the first
        write_json_report(df, path)
        assert open(path, encoding="utf-8").read() == json.dumps(rows, indent=2, ensure_ascii=False)
    assert os.listdir(os.path.dirname(path)) in (["r.json"], [".r.json.crc", "r.json"], ["r.json", ".r.json.crc"])


def test_require_columns(spark):
    with pytest.raises(ValueError, match="no column 'prompt'"):
        require_columns(spark.range(1), ["id", "prompt"])


def test_messages_from_turns_orders_by_turn(spark):
    turns = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    m = messages_from_turns(turns).first()["messages"]
    assert [(x.role, x.content) for x in m] == [("user", "a"), ("assistant", "b")]


def test_load_config(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("datasets:\n  - name: x\nvalidation:\n")
    cfg = load_config(str(p))
    assert cfg["datasets"][0]["name"] == "x" and cfg["validation"] is None
