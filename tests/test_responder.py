"""Replies kept per call, attempts of a task, and the pace of calls."""

import os
import time

import pandas as pd
import pytest

from ideaweave.operators import discovery as disc

PROMPTS = "group_hash string, prompt string"


def _prompts(spark, n, first=0):
    return spark.createDataFrame([(f"h{i}", f"prompt {i}") for i in range(first, first + n)], PROMPTS)


def _ask(prompts, responder, log, **more):
    return disc.respond(prompts, responder, "m", "constellations", "v", "s", concurrency=2, max_retries=0, log=log, **more)


def _counted(folder):
    """A responder that leaves a file per call it gets."""
    def responder(prompt, system):
        with open(f"{folder}/{prompt}-{time.time_ns()}", "w"):
            pass
        if prompt == "prompt 3" and not os.path.exists(f"{folder}/mended"):
            raise ValueError("refused")
        return f" reply to {prompt} ", 7, 3

    return responder


def test_answered_calls_are_not_made_again(spark, tmp_path):
    calls, path = tmp_path / "calls", str(tmp_path / "log")
    calls.mkdir()
    responder = _counted(str(calls))
    log = disc.ReplyLog(path, "run 1")
    first = {r["group_hash"]: (r["text"], r["status"]) for r in _ask(_prompts(spark, 6), responder, log).collect()}
    assert first["h0"] == ("reply to prompt 0", "ok") and first["h3"] == (None, "error") and len(list(calls.iterdir())) == 6
    (calls / "mended").touch()
    again = {r["group_hash"]: (r["text"], r["status"], r["input_tokens"]) for r in _ask(_prompts(spark, 8), responder, log).collect()}
    assert all(again[f"h{i}"] == (f"reply to prompt {i}", "ok", 7) for i in range(8))
    made = [f.name.split("-")[0] for f in calls.iterdir() if "-" in f.name]
    assert sorted(made) == sorted([f"prompt {i}" for i in range(8)] + ["prompt 3"])  # the failed one alone twice
    _ask(_prompts(spark, 2), responder, disc.ReplyLog(path, "run 2")).collect()  # another run asks on its own
    assert len([f for f in calls.iterdir() if "-" in f.name]) == len(made) + 2


def test_a_second_attempt_of_a_task_reads_the_replies_of_the_first(spark, tmp_path):
    """The function of a task that died after some calls is run again on the same rows."""
    calls, taken = [], {}

    def responder(prompt, system):
        calls.append(prompt)
        if len(calls) == 3:
            raise KeyboardInterrupt  # the worker is killed
        return prompt.upper(), 1, 1

    class Prompts:
        sparkSession = spark

        def select(self, *c):
            return self

        def repartition(self, n):
            return self

        def mapInPandas(self, fn, schema):
            taken["fn"] = fn
            return self

    disc.respond(Prompts(), responder, "m", "s", "v", "sys", log=disc.ReplyLog(str(tmp_path / "log"), "r"))
    rows = pd.DataFrame({"group_hash": list("abcde"), "prompt": [f"p{i}" for i in range(5)]})
    with pytest.raises(KeyboardInterrupt):
        list(taken["fn"]([rows]))
    got = pd.concat(taken["fn"]([rows]))
    assert got["text"].tolist() == [f"P{i}" for i in range(5)] and set(got["status"]) == {"ok"}
    made = {p: calls.count(p) for p in calls}
    assert made.pop("p2") == 2 and set(made.values()) == {1}  # only the call that got no reply was made again


def test_pace_and_calls_at_a_time(spark):
    def responder(prompt, system):
        time.sleep(0.5)
        return str(time.time()), 1, 1

    start = time.time()
    fast = [float(r["text"]) for r in _ask(_prompts(spark, 12), responder, None, calls_per_task=6).collect()]
    assert max(fast) - min(fast) < 2.5  # one after the other would take three seconds in each task
    slow = sorted(float(r["text"]) for r in _ask(_prompts(spark, 6), responder, None, calls_per_task=6, per_minute=120).collect())
    assert slow[-1] - slow[0] >= 1.5 and start < slow[0]  # two tasks, a call a second each


def test_log_of_another_store_type_is_refused_plainly(tmp_path):
    with pytest.raises(Exception):
        disc.ReplyLog("nope://x/y").get("00")
