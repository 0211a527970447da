"""Pipeline configuration and the fixed values the results depend on."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass


@dataclass(frozen=True)
class PipelineConfig:
    """Run parameters. Defaults follow the behaviour being reproduced."""

    num_clusters: int = 30
    max_neighborhood_size: int = 30  # declared upstream but never read; the rule below uses 30
    min_neighborhood_size: int = 20
    max_cross_cluster_neighborhoods: int | None = None  # None: every eligible pair (upstream: 10)
    max_total_neighborhoods: int | None = None  # None: all (upstream: 50)
    discovery_model: str = "claude-sonnet-4-5-20250929"
    patterns_model: str = "claude-opus-4-5-20251101"
    min_constellation_score: float = 6
    discovery_concurrency: int = 5
    discovery_max_tokens: int = 2048
    patterns_max_tokens: int = 1024
    cost_budget_usd: float = 15.0

    # k-means
    kmeans_max_iter: int = 30
    kmeans_seed: int = 42
    kmeans_init: str = "lcg"  # "lcg" (exact sequential k-means++), "race" (one pass per round)
    kmeans_empty: str = "origin"  # empty cluster centroid: "origin" or "keep"
    # neighbourhoods
    cross_seed: int = 777
    cross_sampling: str = "lcg"  # "lcg" (exact sequential draws) or "hash" (SHA-256 top-n per side)
    # scale knobs
    broadcast_max_rows: int = 2_000_000
    centroid_broadcast_bytes: int = 256 << 20  # above: relational k-means / stage 2
    salt_buckets: int = 32
    max_hash_members: int = 100_000
    max_prompt_ideas: int | None = 200  # None: one theme prompt per cluster
    calls_per_task: int = 1  # model calls a responder task makes at a time
    calls_per_minute: float | None = None  # of all tasks together
    enforce_budget: bool = False  # skip the theme stage once discovery alone exceeds the budget
    validate_replies: bool = False  # type in the enum, 3..6 ids, ids from the group
    cache_empty: bool = False  # cache a hidden sentinel for groups that produced nothing

    def replace(self, **changes) -> "PipelineConfig":
        return dataclasses.replace(self, **changes)


DEFAULT_CONFIG = PipelineConfig()
WEEKLY_CONFIG = DEFAULT_CONFIG.replace(num_clusters=15, max_cross_cluster_neighborhoods=10, max_total_neighborhoods=25)

# ---------------------------------------------------------------------------
# Fixed values (must equal the reproduced behaviour for identical results)
# ---------------------------------------------------------------------------
SMALL_CLUSTER_MAX = 30  # clusters up to this size form one neighbourhood
MIN_CLUSTER_SIZE = 3  # smaller clusters produce nothing
CHUNK_SIZE = 22  # large clusters are cut into chunks of this many members
CROSS_SAMPLE_PER_SIDE = 4
TFIDF_MIN_DF = 2
TFIDF_MAX_DF_FRACTION = 0.8
TFIDF_MODEL = "tfidf_v1"
# Optional cuts; None: the whole text (upstream: 500, 300, 200, 400, 120)
EMBED_DESCRIPTION_CHARS: int | None = None
DISCOVERY_DESCRIPTION_CHARS: int | None = None
PATTERNS_DESCRIPTION_CHARS: int | None = None
ARXIV_SUMMARY_CHARS: int | None = None
TOP_EXPLANATION_CHARS: int | None = None
RECENT_DAYS = 7
ERROR_TITLE = "__ERROR__"
EMPTY_TITLE = "__EMPTY__"  # our sentinel for a cached group without constellations (cache_empty)
EXPORT_PROMPT_VERSION = "constellation_v3_sonnet"
# columns of the landing ideas that an export fills with a constant
LANDING_DEFAULTS = (
    ("problema_que_resuelve", ""),
    ("potencial_negocio", ""),
    ("dificultad_implementacion", ""),
    ("apto_inversores", "pendiente"),
    ("razon_inversores", ""),
    ("revisado", "pendiente"),
    ("notas", ""),
    ("combina_con", ""),
    ("frontier", ""),
)
CONSTELLATION_TYPES = ("triangulation", "spectrum", "chain", "convergence", "absence")
LCG_MULTIPLIER = 1664525
LCG_INCREMENT = 1013904223
LCG_DIVISOR = 0xFFFFFFFF
RETRY_STATUS = (429, 529)
RETRY_BASE_MS = 2000
RETRY_MAX_MS = 30000
RETRY_MAX = 3

# USD per million tokens: (model, input, output)
MODEL_PRICING = (
    ("claude-haiku-4-5-20251001", 0.80, 4.00),
    ("claude-sonnet-4-5-20250929", 3.00, 15.00),
    ("claude-sonnet-4-6-20260514", 3.00, 15.00),
    ("claude-opus-4-5-20251101", 15.00, 75.00),
    ("claude-opus-4-6-20260409", 15.00, 75.00),
)

# Source normaliser constants
HN_MIN_SCORE = 30
# Optional caps on items of a fetch; None: all (upstream: 500, 400, 20, 25, 20, 20 and 100 / 50 / 50)
HN_MAX_POLL: int | None = None
HN_TARGET: int | None = None
PH_HTML_MAX: int | None = None
YC_MAX: int | None = None
BETALIST_MAX: int | None = None
PWC_MAX: int | None = None
HF_LIMITS: tuple = (("model", None), ("space", None), ("dataset", None))

# Our own prompt versions (the prompt wording is our own)
DISCOVERY_PROMPT_VERSION = "iw_discovery_v1"
PATTERNS_PROMPT_VERSION = "iw_patterns_v1"
