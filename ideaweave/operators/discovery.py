"""Discovery over groups (G1-G11): prompt rendering, batch responder, reply parsing, merge.

The responder is a user callable ``fn(prompt, system) -> (text, input_tokens, output_tokens)``.
It runs inside ``mapInPandas`` over a prompts table repartitioned to ``concurrency`` tasks,
with retries for rate-limit style errors. Responses are a table; with a ``ReplyLog`` an answered call is
never made again, neither by a later attempt of a task nor by a later start of the run. Failures become
``status='error'`` rows -- one bad group never fails the job.
"""

from __future__ import annotations

import inspect
import json
import hashlib
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, NamedTuple

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (CONSTELLATION_TYPES, DEFAULT_CONFIG, DISCOVERY_DESCRIPTION_CHARS, EMPTY_TITLE, ERROR_TITLE,
                      PATTERNS_DESCRIPTION_CHARS, RETRY_BASE_MS, RETRY_MAX, RETRY_MAX_MS, RETRY_STATUS,
                      PipelineConfig)
from ..config import DISCOVERY_PROMPT_VERSION, PATTERNS_PROMPT_VERSION  # noqa: F401  (re-exported)
from ..functions.text import item_line, outer_json_object, round_clamp_1_10, set_hash

# ---------------------------------------------------------------------------
# Prompt text (our own wording; versioned by DISCOVERY/PATTERNS_PROMPT_VERSION)
# ---------------------------------------------------------------------------
DISCOVERY_SYSTEM = "You look for non-obvious structure across short descriptions of products, tools and papers."
DISCOVERY_HEAD = ("Below are {n} items. Find small groups of 3 to 6 items that together show something none of "
                  "them shows alone. Kinds: triangulation, spectrum, chain, convergence, absence.\n"
                  "Answer with one JSON object: {\"constellations\": [{\"type\": kind, \"idea_ids\": [ids], "
                  "\"title\": text, \"explanation\": text, \"score\": 1-10, \"actionability\": 1-10 (absence only)}]}\n\n"
                  "Items:\n")
PATTERNS_SYSTEM = "You name recurring themes in a cluster of short item descriptions."
PATTERNS_HEAD = ("These items were grouped together. Name the themes they share.\n"
                 "Answer with one JSON object: {\"patterns\": [{\"name\": text, \"idea_ids\": [ids], "
                 "\"explanation\": text}]}\n\nItems:\n")

CONSTELLATION_SCHEMA = T.StructType([T.StructField("constellations", T.ArrayType(T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("idea_ids", T.ArrayType(T.LongType())),
    T.StructField("title", T.StringType()),
    T.StructField("explanation", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("actionability", T.DoubleType()),
])))])

PATTERN_SCHEMA = T.StructType([T.StructField("patterns", T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("idea_ids", T.ArrayType(T.LongType())),
    T.StructField("explanation", T.StringType()),
])))])

RESPONSE_SCHEMA = ("group_hash string, prompt_version string, model string, stage string, text string, "
                   "input_tokens long, output_tokens long, status string, error string")


def discovery_prompt(n_items, text) -> F.Column:
    head = DISCOVERY_HEAD.split("{n}")
    return F.concat(F.lit(head[0]), n_items.cast("string"), F.lit(head[1]), text)


def patterns_prompt(text) -> F.Column:
    return F.concat(F.lit(PATTERNS_HEAD), text)


# ---------------------------------------------------------------------------
# Group text and prompts
# ---------------------------------------------------------------------------

def neighborhood_prompts(members: DataFrame, ideas: DataFrame, broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """One prompt per neighbourhood: (neighborhood_id, group_hash, n_items, prompt).

    Groups are bounded (<= 41 members), so collecting a group's lines is safe. Unknown ids
    are dropped from the text but counted in ``n_items`` and included in the hash. The member
    list (at most max_total x 41 rows, size-checked) is broadcast against the ideas table, so
    the corpus is scanned once and never shuffled to find a few thousand lines.
    """
    stats = members.groupBy("neighborhood_id").agg(set_hash(F.collect_list("idea_id")).alias("group_hash"),
                                                   F.count(F.lit(1)).alias("n_items"))
    m = members.select("neighborhood_id", "ordinal", "idea_id")
    small = F.broadcast(m) if m.count() <= broadcast_max_rows else m
    lines = ideas.select("idea_id", item_line(chars=DISCOVERY_DESCRIPTION_CHARS).alias("line")).join(small, "idea_id")
    text = lines.groupBy("neighborhood_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "line"))), lambda x: x["line"]),
                     "\n").alias("text"))
    g = stats.join(text, "neighborhood_id", "left")
    return g.select("neighborhood_id", "group_hash", F.col("n_items").cast("bigint"),
                    discovery_prompt(F.col("n_items"), F.coalesce(F.col("text"), F.lit(""))).alias("prompt"))


def member_hashes(assign: DataFrame, per: int) -> DataFrame:
    """(cluster_id, group_hash, n_members): SHA-256 of each cluster's sorted id list, at every size.

    The ids are range-sorted over all tasks and joined into pieces of at most ``per`` ids; the pieces
    of a cluster then run through one hash in order, so no cluster is collected whole.
    """
    kind = assign.schema["cluster_id"].dataType.simpleString()
    id_kind = assign.schema["idea_id"].dataType.simpleString()
    p = int(assign.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = (assign.select("cluster_id", "idea_id", F.col("idea_id").cast("string").alias("name"))
           .repartitionByRange(p, "cluster_id", "idea_id").sortWithinPartitions("cluster_id", "idea_id"))

    def cut(batches):
        held, names, k = None, [], 0  # held: cluster, first id, members

        def piece():
            nonlocal held, names, k
            text = [x for x in names if x is not None]
            got = [pa.array([v], t) for v, t in zip(
                (held[0], held[1], k, ",".join(text) if text else None, held[2]), types)]
            held, names, k = None, [], k + 1
            return pa.RecordBatch.from_arrays(got, names=["cluster_id", "first", "k", "text", "n"])

        for b in batches:
            types = [b.schema.field(0).type, b.schema.field(1).type, pa.int64(), pa.string(), pa.int64()]
            for c, i, name in zip(*[x.to_pylist() for x in b.columns]):
                if held and (held[0] != c or held[2] >= per):
                    yield piece()
                if not held:
                    held = [c, i, 0]
                held[2] += 1
                names.append(name)
        if held:
            yield piece()

    def digest(batches):
        now, out = None, []  # now: cluster, hash, members, whether an id was hashed
        for b in batches:
            t = b.schema.field(0).type
            for c, text, n in zip(*[b.column(x).to_pylist() for x in ("cluster_id", "text", "n")]):
                if now and now[0] != c:
                    out.append((now[0], now[1].hexdigest(), now[2]))
                    now = None
                now = now or [c, hashlib.sha256(), 0, False]
                if text is not None:
                    now[1].update((("," if now[3] else "") + text).encode())
                    now[3] = True
                now[2] += n
        if now:
            out.append((now[0], now[1].hexdigest(), now[2]))
            yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*out), (t, pa.string(), pa.int64()))],
                                             names=["cluster_id", "group_hash", "n_members"])

    pieces = ids.mapInArrow(cut, f"cluster_id {kind}, first {id_kind}, k long, text string, n long")
    return (pieces.repartition(p, "cluster_id").sortWithinPartitions("cluster_id", "first", "k")
            .mapInArrow(digest, f"cluster_id {kind}, group_hash string, n_members long"))


def cluster_prompts(assign: DataFrame, ideas: DataFrame, cfg: PipelineConfig = DEFAULT_CONFIG,
                    sizes: dict | None = None) -> DataFrame:
    """Theme prompts for clusters with >= 3 members: (cluster_id, part, group_hash, n_members, prompt).

    The hash is SHA-256 of the sorted ids of all members, whatever their number
    (``max_hash_members`` is the size of a piece of that list, not a limit). Members are printed in id order, in parts of ``max_prompt_ideas``, so a huge cluster becomes several
    prompts that together still show every member -- no group is collected whole.
    ``max_prompt_ideas=None`` renders one prompt per cluster whatever its size (its lines meet in one row).
    """
    from .ranking import rank_within
    if sizes is None:
        sizes = {r[0]: r[1] for r in assign.groupBy("cluster_id").count().collect()}
    keep = [c for c, n in sizes.items() if n >= 3]
    a = assign.where(F.col("cluster_id").isin(keep)).select("idea_id", "cluster_id")
    hashes = member_hashes(a, cfg.max_hash_members)
    per = cfg.max_prompt_ideas
    if per is not None and any(sizes[c] > per for c in keep):  # ids are ranked, not texts
        a = rank_within(a, "cluster_id", ["idea_id"]).select(
            "idea_id", "cluster_id", F.floor((F.col("rank") - 1) / per).cast("int").alias("part"))
    else:
        a = a.withColumn("part", F.lit(0))
    lines = ideas.select("idea_id", item_line(chars=PATTERNS_DESCRIPTION_CHARS).alias("line"))
    # below the checked bound the texts are exchanged once, to meet in their part
    lines = lines.join(F.broadcast(a) if sum(sizes[c] for c in keep) <= cfg.broadcast_max_rows else a, "idea_id")
    g = lines.groupBy("cluster_id", "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idea_id", "line"))), lambda x: x["line"]),
                     "\n").alias("text"))
    return (g.join(hashes, "cluster_id")
            .select("cluster_id", "part", "group_hash", F.col("n_members").cast("bigint"),
                    patterns_prompt(F.col("text")).alias("prompt")))


# ---------------------------------------------------------------------------
# Responder application with retry and failure isolation
# ---------------------------------------------------------------------------

class ResponderError(Exception):
    def __init__(self, msg: str, status: int | None = None):
        super().__init__(msg)
        self.status = status


def _with_retry(call, max_retries: int = RETRY_MAX, sleep=time.sleep):
    attempt = 0
    while True:
        try:
            return call()
        except Exception as e:  # noqa: BLE001
            status = getattr(e, "status", None)
            if status in RETRY_STATUS and attempt < max_retries:
                sleep(min(RETRY_BASE_MS * (2 ** attempt), RETRY_MAX_MS) / 1000.0)
                attempt += 1
                continue
            raise


class ReplyLog:
    """Replies as one object per call in a shared folder, so that a call that was answered is not made again.

    A reply is written as soon as it is there, under the hash of its call. An attempt of a task finds
    the replies of the attempt before it; what a run finds at its start never reaches a task
    (``logged``). Only answered calls are kept. A call whose reply was lost before it was written is
    made again.
    """

    def __init__(self, path: str, run: str = ""):
        self.path, self.run = path.rstrip("/"), run

    def key(self, model: str, version: str, system: str, prompt: str) -> str:
        return hashlib.sha256("\x1f".join([self.run, model, version, system, prompt]).encode()).hexdigest()

    def column(self, model: str, version: str, system: str) -> Column:
        return F.sha2(F.concat_ws("\x1f", F.lit(self.run), F.lit(model), F.lit(version), F.lit(system), F.col("prompt")), 256)

    def _store(self):
        return pafs.FileSystem.from_uri(self.path) if "://" in self.path else (pafs.LocalFileSystem(), self.path.removeprefix("file:"))

    def get(self, key: str):
        store, base = self._store()
        try:
            with store.open_input_stream(f"{base}/{key[:2]}/{key}.json") as f:
                r = json.loads(f.read())
        except FileNotFoundError:
            return None
        return r["text"], r["input_tokens"], r["output_tokens"]

    def put(self, key: str, text: str, tokens_in: int, tokens_out: int) -> None:
        store, base = self._store()
        store.create_dir(f"{base}/{key[:2]}", recursive=True)
        part = f"{base}/{key[:2]}/_{key}-{uuid.uuid4().hex}"  # names with _ are no data to Spark
        with store.open_output_stream(part) as f:
            f.write(json.dumps({"key": key, "text": text, "input_tokens": tokens_in, "output_tokens": tokens_out}).encode())
        store.move(part, f"{base}/{key[:2]}/{key}.json")

    def logged(self, spark) -> DataFrame | None:
        """``(key, text, input_tokens, output_tokens)`` of all replies, or None."""
        from .store import hadoop_fs
        fs, files = hadoop_fs(spark, f"{self.path}/*/*.json")
        if not fs.globStatus(files):
            return None
        return spark.read.schema("key string, text string, input_tokens long, output_tokens long").json(f"{self.path}/*/")


class StoredReplies:
    """A responder that makes no call: ``replies(prompts)`` gives the stored ``(group_hash, prompt, text,
    input_tokens, output_tokens)`` of prompts ``(group_hash, prompt)``; a prompt without one is an error row."""

    def __init__(self, replies: Callable[[DataFrame], DataFrame]):
        self.replies = replies

    def respond(self, prompts: DataFrame, model: str, stage: str, prompt_version: str) -> DataFrame:
        asked, key = prompts.select("group_hash", "prompt"), F.sha2("prompt", 256).alias("key")
        got = self.replies(asked).select("group_hash", key, "text", "input_tokens", "output_tokens")
        found = F.col("text").isNotNull()
        # a prompt is told by its hash: prompts hold all texts of their group
        return asked.select("group_hash", key).join(got, ["group_hash", "key"], "left").select(
            "group_hash", F.lit(prompt_version).alias("prompt_version"), F.lit(model).alias("model"), F.lit(stage).alias("stage"),
            F.trim("text").alias("text"), F.coalesce("input_tokens", F.lit(0)).cast("bigint").alias("input_tokens"),
            F.coalesce("output_tokens", F.lit(0)).cast("bigint").alias("output_tokens"),
            F.when(found, "ok").otherwise("error").alias("status"), F.when(~found, "no stored reply").alias("error"))


class _Pace:
    """Calls of a task begin at least ``gap`` seconds apart."""

    def __init__(self, gap: float):
        self.gap, self.next, self.lock = gap, 0.0, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            now = time.monotonic()
            start = max(now, self.next)
            self.next = start + self.gap
        if start > now:
            time.sleep(start - now)


def respond(prompts: DataFrame, responder: Callable, model: str, stage: str, prompt_version: str,
            system: str, concurrency: int = 5, max_retries: int = RETRY_MAX, max_tokens: int | None = None,
            log: ReplyLog | None = None, calls_per_task: int = 1, per_minute: float | None = None) -> DataFrame:
    """Call ``responder`` once per prompt row; returns the response table (RESPONSE_SCHEMA).

    The call is ``responder(prompt, system)``, with ``model=`` and ``max_tokens=`` (the longest
    reply) added where the responder has these parameters. ``concurrency`` tasks make up to
    ``calls_per_task`` calls each at a time; ``per_minute`` bounds the calls of all tasks together,
    whatever their number. With a ``log``, answered calls are read from it.
    """
    if isinstance(responder, StoredReplies):
        return responder.respond(prompts, model, stage, prompt_version)
    takes = inspect.signature(responder).parameters
    extra = {k: v for k, v in (("model", model), ("max_tokens", max_tokens)) if k in takes}
    gap = 60.0 * concurrency / per_minute if per_minute else 0.0
    names = ["group_hash", "prompt_version", "model", "stage", "text", "input_tokens", "output_tokens", "status", "error"]

    def fn(it):
        pace = _Pace(gap)

        def one(row):
            h, p = row
            try:
                key = log.key(model, prompt_version, system, p) if log else None
                got = log.get(key) if log else None
                if got is None:
                    def call():
                        pace.wait()
                        return responder(p, system, **extra)

                    text, tin, tout = _with_retry(call, max_retries)
                    got = (text or "").strip(), int(tin or 0), int(tout or 0)
                    if log:
                        log.put(key, *got)
                return (h, prompt_version, model, stage, *got, "ok", None)
            except Exception as e:  # noqa: BLE001
                return h, prompt_version, model, stage, None, 0, 0, "error", str(e)

        with ThreadPoolExecutor(calls_per_task) as pool:
            for pdf in it:
                rows = list(pool.map(one, zip(pdf["group_hash"].tolist(), pdf["prompt"].tolist())))
                yield pd.DataFrame(rows, columns=names)

    todo, found = prompts.select("group_hash", "prompt"), None
    kept = log.logged(prompts.sparkSession) if log else None
    if kept is not None:
        keyed = todo.withColumn("key", log.column(model, prompt_version, system))
        found = keyed.join(kept, "key").select(
            "group_hash", F.lit(prompt_version).alias("prompt_version"), F.lit(model).alias("model"), F.lit(stage).alias("stage"),
            "text", "input_tokens", "output_tokens", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error"))
        todo = keyed.join(kept.select("key"), "key", "left_anti").select("group_hash", "prompt")
    out = todo.repartition(concurrency).mapInPandas(fn, RESPONSE_SCHEMA)
    return out if found is None else out.unionByName(found)


# ---------------------------------------------------------------------------
# Reply parsing
# ---------------------------------------------------------------------------

class Parsed(NamedTuple):
    rows: DataFrame
    errors: DataFrame  # group_hash, reason


def _json_part(responses: DataFrame) -> DataFrame:
    j = outer_json_object(F.col("text"))
    return responses.where(F.col("status") == "ok").withColumn("_j", j)


def parse_constellations(responses: DataFrame, min_score: float, validate: bool = False,
                         members: DataFrame | None = None) -> Parsed:
    """Reply text -> constellation rows; score >= min_score; actionability only for 'absence'."""
    r = _json_part(responses)
    valid = F.json_object_keys(F.col("_j")).isNotNull()
    p = r.withColumn("_p", F.when(valid, F.from_json("_j", CONSTELLATION_SCHEMA)))
    ex = p.select("group_hash", "model", "prompt_version",
                  F.posexplode(F.coalesce(F.col("_p.constellations"), F.array())).alias("item_ord", "c"))
    act = F.when((F.col("c.type") == "absence") & F.col("c.actionability").isNotNull(),
                 round_clamp_1_10(F.col("c.actionability")))
    rows = ex.select(F.col("group_hash").alias("neighborhood_hash"), "item_ord",
                     F.col("c.type").alias("constellation_type"), F.col("c.idea_ids").alias("idea_ids"),
                     F.col("c.title").alias("title"), F.col("c.explanation").alias("explanation"),
                     F.col("c.score").alias("score"), act.cast("int").alias("actionability"),
                     "model", "prompt_version")
    errors = (r.where(F.col("_j") == "").select("group_hash", F.lit("no json").alias("reason"))
              .unionByName(r.where((F.col("_j") != "") & ~valid).select("group_hash", F.lit("malformed json").alias("reason")))
              .unionByName(rows.where(F.col("score").isNull()).select(F.col("neighborhood_hash").alias("group_hash"),
                                                                       F.lit("missing score").alias("reason")))
              .unionByName(responses.where(F.col("status") != "ok").select("group_hash", F.lit("call failed").alias("reason"))))
    kept = rows.where(F.col("score") >= F.lit(float(min_score)))
    if validate:
        kept = validate_constellations(kept, members)
    return Parsed(kept, errors)


def validate_constellations(rows: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Optional checks the reproduced behaviour does not make: type, 3..6 ids, ids from the group."""
    out = rows.where(F.col("constellation_type").isin(*CONSTELLATION_TYPES)
                     & (F.size("idea_ids") >= 3) & (F.size("idea_ids") <= 6))
    if members is not None:
        grp = members.groupBy("group_hash").agg(F.collect_set("idea_id").alias("_m"))
        out = (out.join(grp, out["neighborhood_hash"] == grp["group_hash"], "left")
               .where(F.size(F.array_except("idea_ids", F.coalesce("_m", F.array().cast("array<bigint>")))) == 0)
               .drop("_m", "group_hash"))
    return out


def parse_patterns(responses: DataFrame) -> Parsed:
    """Reply text -> pattern rows: name -> pattern_title, explanation -> pattern_description."""
    r = _json_part(responses)
    valid = F.json_object_keys(F.col("_j")).isNotNull()
    p = r.withColumn("_p", F.when(valid, F.from_json("_j", PATTERN_SCHEMA)))
    ex = p.select("group_hash", "model", "prompt_version",
                  F.posexplode(F.coalesce(F.col("_p.patterns"), F.array())).alias("item_ord", "p"))
    rows = ex.select(F.col("group_hash").alias("cluster_hash"), "item_ord", F.col("p.name").alias("pattern_title"),
                     F.col("p.explanation").alias("pattern_description"),
                     F.coalesce(F.col("p.idea_ids"), F.array().cast("array<bigint>")).alias("idea_ids"),
                     "model", "prompt_version")
    errors = (r.where(F.col("_j") == "").select("group_hash", F.lit("no json").alias("reason"))
              .unionByName(r.where((F.col("_j") != "") & ~valid).select("group_hash", F.lit("malformed json").alias("reason")))
              .unionByName(responses.where(F.col("status") != "ok").select("group_hash", F.lit("call failed").alias("reason"))))
    return Parsed(rows, errors)


# ---------------------------------------------------------------------------
# Merge with cache, counters
# ---------------------------------------------------------------------------

def merge_columns() -> list:
    return ["neighborhood_hash", "item_ord", "constellation_type", "idea_ids", "title", "explanation", "score",
            "actionability", "model", "prompt_version"]


def merge_cached_constellations(cached_hits: DataFrame, fresh: DataFrame, model: str,
                                extra: list | None = None) -> DataFrame:
    """Cached rows (minus ``__ERROR__`` placeholders) relabelled with the current model, plus fresh rows.

    Cached rows are not re-filtered by the minimum score.
    """
    cols = ["neighborhood_hash", "constellation_type", "idea_ids", "title", "explanation", "score",
            "actionability", "model", "prompt_version"] + list(extra or [])
    c = (cached_hits.where(~F.col("title").isin(ERROR_TITLE, EMPTY_TITLE)).withColumn("model", F.lit(model))
         .select(*cols))
    return c.unionByName(fresh.select(*cols))


def empty_sentinels(responses: DataFrame, rows: DataFrame, model: str, version: str) -> DataFrame:
    """One hidden row per answered group that yielded no constellation (for ``cache_empty``)."""
    done = responses.where(F.col("status") == "ok").select(F.col("group_hash").alias("neighborhood_hash"))
    empty = done.join(rows.select("neighborhood_hash"), "neighborhood_hash", "left_anti").distinct()
    return empty.select("neighborhood_hash", F.lit(-1).cast("int").alias("item_ord"),
                        F.lit(None).cast("string").alias("constellation_type"),
                        F.array().cast("array<bigint>").alias("idea_ids"), F.lit(EMPTY_TITLE).alias("title"),
                        F.lit("").alias("explanation"), F.lit(None).cast("double").alias("score"),
                        F.lit(None).cast("int").alias("actionability"), F.lit(model).alias("model"),
                        F.lit(version).alias("prompt_version"))


def call_counters(responses: DataFrame, hits: DataFrame | None = None, key: str = "group_hash") -> DataFrame:
    """cache_hits, api_calls, input/output tokens -- aggregates over the tables, not accumulators."""
    calls = responses.agg(
        F.coalesce(F.sum(F.when(F.col("status") == "ok", 1).otherwise(0)), F.lit(0)).cast("bigint").alias("api_calls"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).cast("bigint").alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).cast("bigint").alias("output_tokens"))
    n_hits = 0 if hits is None else hits.select(key).distinct().count()
    return calls.select(F.lit(n_hits).cast("bigint").alias("cache_hits"), "*")
