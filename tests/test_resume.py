"""Runs that are cut and resumed, and answers that are asked once."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from noema.operators import enrich as E
from noema.operators.answers import AnswerStore
from noema.streaming.resume import epoch_writer, run_resumable

ITEMS = "name string, n int"


def write_files(folder, files):
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(files):
        path = os.path.join(folder, f"part{i}.json")
        with open(path, "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


FILES = [[{"name": "a", "n": 2}, {"name": "b", "n": 1}, {"name": "a", "n": 1}], [{"name": "b", "n": 0}, {"name": "c", "n": 5}],
         [{"name": None, "n": 1}, {"name": "c", "n": 1}, {"name": "d", "n": None}], [{"name": "a", "n": 0}, {"name": "e", "n": 7}]]


def run(spark, base, process, **kw):
    return run_resumable(spark, f"{base}/in", ITEMS, "name", process, f"{base}/done", f"{base}/ckpt", fmt="json",
                         max_files_per_trigger=1, **kw)


def rows(df):
    return sorted((r["name"], r["n"], r["result"]) for r in df.collect())


@pytest.mark.parametrize("cut_at", [1, 2, 3, 4])
def test_cut_and_resumed_equals_uncut(spark, tmp_path, cut_at):
    upper = lambda df: df.withColumn("result", F.upper("name"))
    write_files(tmp_path / "one" / "in", FILES)
    write_files(tmp_path / "two" / "in", FILES)
    want = rows(run(spark, tmp_path / "one", upper))
    assert want == [("a", 1, "A"), ("b", 1, "B"), ("c", 5, "C"), ("d", None, "D"), ("e", 7, "E")]
    batches = []

    def fails(df):
        batches.append(1)
        if len(batches) == cut_at:
            raise RuntimeError("lost")
        return upper(df)
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path / "two", fails)
    assert rows(run(spark, tmp_path / "two", upper)) == want
    again = run(spark, tmp_path / "two", lambda df: df.withColumn("result", F.lit("asked again")))
    assert rows(again) == want


def test_a_replayed_epoch_replaces_what_it_left(spark, tmp_path):
    """Written, but not committed: the batch comes again with its epoch."""
    write = epoch_writer(lambda df: df, str(tmp_path / "done"))
    batch = spark.createDataFrame([("a", 1), ("b", 2)], ITEMS)
    write(batch, 0)
    write(batch, 1)
    write(batch, 1)
    assert spark.read.parquet(str(tmp_path / "done")).groupBy("epoch").count().orderBy("epoch").collect() == [(0, 2), (1, 2)]


def asked(log):
    return Counter(line for name in os.listdir(log) for line in open(os.path.join(log, name)).read().split("\n") if line)


def logging_model(log, flag=None):
    """Answers and notes each prompt in a file of the call; fails after three prompts while ``flag`` exists."""
    def model(systems, users):
        import uuid
        if flag and os.path.exists(flag) and sum(asked(log).values()) >= 3:
            raise RuntimeError("model lost")
        with open(os.path.join(log, uuid.uuid4().hex), "w") as f:
            f.write("\n".join(systems))
        return [json.dumps({"alias": [s[-1].upper()]}) for s in systems]
    return model


def prompts(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string").select(F.concat(F.lit("name "), "name").alias("system"), F.lit("u").alias("user"))
    return df.withColumn("prompt_key", E.prompt_key(F.col("system"), F.col("user")))


def test_failed_task_asks_only_the_unfinished_batch_again(spark, tmp_path):
    log, flag = tmp_path / "log", tmp_path / "flag"
    log.mkdir()
    flag.touch()
    names = [chr(97 + i) for i in range(12)]
    p = prompts(spark, names).coalesce(1).sortWithinPartitions("system")
    store = AnswerStore(str(tmp_path / "store"), logging_model(str(log), str(flag)), prompts_per_file=3, files_per_batch=1)
    with pytest.raises(Exception, match="model lost"):
        E.generate(p, store)
    kept = {r.raw for r in store.answers(spark).collect()}
    before = asked(log)
    finished = {s for s in before if json.dumps({"alias": [s[-1].upper()]}) in kept}
    assert len(finished) == 3
    flag.unlink()
    out = {r.raw for r in E.generate(p, store).collect()}
    assert out == {json.dumps({"alias": [n.upper()]}) for n in names}
    after = asked(log)
    assert all(after[s] == 1 for s in finished) and set(after) == {f"name {n}" for n in names}
    # a later call asks only what is new
    more = E.generate(prompts(spark, ["a", "b", "z"]), store).collect()
    assert sorted(json.loads(r.raw)["alias"][0] for r in more) == ["A", "B", "Z"]
    assert asked(log) - after == Counter({"name z": 1})


def test_no_prompts(spark, tmp_path):
    store = AnswerStore(str(tmp_path / "store"), logging_model(str(tmp_path)))
    assert E.generate(prompts(spark, []), store).count() == 0
