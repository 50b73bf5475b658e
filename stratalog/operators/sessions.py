"""Session context, history windows and prompts, in batch form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog import config as C
from stratalog.config import SessionConfig, SkewConfig
from stratalog.functions.audit_rules import has_text
from stratalog.functions.text import estimate_tokens, fill, strip
from stratalog.functions.times import micros
from stratalog.operators.capped import capped_events
from stratalog.operators.lifetimes import interleaved, lifetime_starts
from stratalog.operators.skew import BLOCK, Scan, last_known, mark_blocks, scan, scan_marked, tail

CONTEXT = ("well_name", "summary", "n_zones", "dominant_lithology", "mean_confidence")


def sessions(
    events: DataFrame, cfg: SessionConfig = SessionConfig(), skew: SkewConfig = SkewConfig()
) -> DataFrame:
    """``(session_id, created_at)`` of every session: it lives a fixed time from its creation."""
    starts = lifetime_starts(events, ["session_id"], "ts", cfg.ttl_seconds, skew)
    return starts.select("session_id", F.timestamp_micros("t").alias("created_at"))


def live_sessions(
    created: DataFrame, as_of: Column, cfg: SessionConfig = SessionConfig()
) -> DataFrame:
    """Sessions alive at a time; beyond the cap the oldest by creation go first."""
    age = micros(as_of) - micros("created_at")
    alive = created.where((age >= 0) & (age <= cfg.ttl_seconds * 1_000_000))
    return alive.orderBy(F.col("created_at").desc(), "session_id").limit(cfg.max_sessions)


def with_context(
    events: DataFrame,
    order: list[str] | None = None,
    cfg: SessionConfig = SessionConfig(),
    skew: SkewConfig = SkewConfig(),
) -> DataFrame:
    """Every event with its session and the latest prediction of that session.

    ``events(session_id, ts, kind, <context>)``; rows of kind ``prediction`` carry the context
    columns that exist; ``order`` begins with ``ts``. Session starts, predictions and turns go through
    one ordered scan, so the as-of lookups need no join. A prediction without zones resets class and
    confidence.
    """
    fields = [c for c in CONTEXT if c in events.columns]
    held = F.when(
        F.col("kind") == "prediction",
        F.struct(micros("ts").alias("at"), *[F.col(c) for c in fields]),
    )
    base = events.withColumn("_p", held).drop(*fields)
    seen = _placed(base, order, cfg, skew, _ctx=last_known(F.col("_p")))
    current = F.col("_ctx.at") >= micros("created_at")
    return seen.select(
        *[c for c in events.columns if c not in fields],
        "created_at",
        F.coalesce(current, F.lit(False)).alias("has_context"),
        *[F.when(current, F.col(f"_ctx.{c}")).alias(c) for c in fields],
    )


def with_capped_context(
    events: DataFrame,
    order: list[str],
    cfg: SessionConfig = SessionConfig(),
    skew: SkewConfig = SkewConfig(),
) -> DataFrame:
    """Like :func:`with_context` where the cap ends sessions too: an event after that opens a new one,
    which knows nothing of the predictions before."""
    fields = [c for c in CONTEXT if c in events.columns]
    held = F.when(F.col("kind") == "prediction", F.struct(*[F.col(c) for c in fields]))
    seen, _ = capped_events(events.withColumn("_p", held).drop(*fields), order, cfg, skew)
    current = scan(seen, ["session_id", "created_at"], order, skew, _ctx=last_known(F.col("_p")))
    return current.select(
        *[c for c in events.columns if c not in fields],
        "created_at",
        F.col("_ctx").isNotNull().alias("has_context"),
        *[F.col(f"_ctx.{c}").alias(c) for c in fields],
    )


def evictions(
    events: DataFrame, order: list[str], cfg: SessionConfig = SessionConfig(), skew: SkewConfig = SkewConfig()
) -> DataFrame:
    """``(session_id, created_at, ended_at)`` of the sessions that the cap ended before their time."""
    return capped_events(events.select("session_id", *order), order, cfg, skew)[1]


def _placed(
    events: DataFrame,
    order: list[str] | None,
    cfg: SessionConfig,
    skew: SkewConfig,
    **columns: Scan,
) -> DataFrame:
    """Events with ``created_at`` of their session and further running columns."""
    keys = ["session_id"]
    starts = lifetime_starts(events, keys, "ts", cfg.ttl_seconds, skew)
    probe = events.select(*keys, F.col("ts").cast("timestamp").alias("ts"))
    places = ["ts", "_mark", *(order or ["ts"])[1:]]
    marked = mark_blocks(interleaved(events, keys, "ts", starts), keys, places, skew, probe)
    seen = scan_marked(
        marked, keys, places, _created=last_known(F.col("_start")), **columns
    )
    return (
        seen.where("_mark = 1")
        .withColumn("created_at", F.timestamp_micros("_created"))
        .drop("_mark", "_start", "_created", BLOCK)
    )


def attached(
    events: DataFrame,
    order: list[str] | None = None,
    cfg: SessionConfig = SessionConfig(),
    skew: SkewConfig = SkewConfig(),
) -> DataFrame:
    """Final context of each session, ``(session_id, created_at, …)``: newest prediction wins."""
    fields = [c for c in CONTEXT if c in events.columns]
    placed = _placed(events, order, cfg, skew)
    at = F.when(F.col("kind") == "prediction", F.struct(*(order or ["ts"])))
    return placed.groupBy("session_id", "created_at").agg(
        F.count_if(F.col("kind") == "prediction").alias("n_predictions"),
        *[F.max_by(F.struct(c), at)[c].alias(c) for c in fields],
    )


def session_info(attached_: DataFrame) -> DataFrame:
    return attached_.select(
        "session_id",
        (F.col("n_predictions") > 0).alias("has_well_context"),
        "well_name",
        "n_zones",
        F.date_format(
            F.to_utc_timestamp("created_at", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"
        ).alias("created_at"),
    )


def history(
    turns: DataFrame, cfg: SessionConfig = SessionConfig(), skew: SkewConfig = SkewConfig()
) -> DataFrame:
    """User and assistant turns with the rendered messages before them in ``history``."""
    spoken = turns.where(F.col("role").isin("user", "assistant"))
    line = F.concat(
        F.when(F.col("role") == "user", F.lit("User: ")).otherwise(F.lit("Assistant: ")),
        strip(F.col("text")),
    )
    size = cfg.history_turns * 2
    seen = scan(
        spoken.withColumn("_line", line), ["conv_id"], ["turn"], skew,
        _before=tail(F.struct("_line"), size),
    )
    return seen.withColumn(
        "history",
        F.when(
            F.size("_before") > 0,
            fill(
                C.HISTORY_FRAME, F.array_join(F.transform("_before", lambda b: b["_line"]), "\n")
            ),
        ),
    ).drop("_before", "_line")


def message(
    df: DataFrame, system: str | None, cfg: SessionConfig = SessionConfig()
) -> DataFrame:
    """One prompt from ``(question, summary, history)`` within the token budget.

    The history is one block: over budget it goes as a whole. Rules are added after the test, and
    only with a summary. ``system`` None leaves both the system text and the rules out.
    """
    context = F.when(has_text(F.col("summary")), fill(C.CONTEXT_FRAME, F.col("summary")))
    head = f"{system}\n\n" if system else ""
    asked = F.concat(F.lit(f"{head}Question: "), strip(F.col("question")))
    full = F.concat_ws(C.BLOCK_SEPARATOR, context, F.col("history"), asked)
    bare = F.concat_ws(C.BLOCK_SEPARATOR, context, asked)
    fits = estimate_tokens(full) <= cfg.max_prompt_tokens
    body = F.when(fits, full).otherwise(bare)
    rules = F.when(
        F.lit(system is not None) & has_text(F.col("summary")), F.lit(C.LITHOLOGY_RULES)
    )
    return df.withColumns(
        {
            "trimmed": ~fits & F.col("history").isNotNull(),
            "over_budget": estimate_tokens(body) > cfg.max_prompt_tokens,
            "message": F.concat_ws("\n\n", body, rules),
        }
    )


def route(df: DataFrame) -> DataFrame:
    """A file goes to the lithology model; otherwise chat goes on with the earlier summary."""
    file = has_text(F.col("file"))
    return df.withColumns(
        {
            "route": F.when(file, "lithology").otherwise("chat"),
            "summary": F.when(~file, F.col("prior_summary")),
        }
    )


def answer_prompt(df: DataFrame, system: str) -> DataFrame:
    """System and user text for one answer, wrapped with the summary where there is one."""
    shown = has_text(F.col("summary"))
    asked = strip(F.col("question"))
    user = F.when(shown, fill(C.SHOWN_FRAME, F.col("summary"), asked)).otherwise(asked)
    return df.withColumns(
        {
            "system": F.when(shown, F.lit(f"{system}\n\n{C.LITHOLOGY_RULES}")).otherwise(
                F.lit(system)
            ),
            "user": user,
            "prompt_tokens": estimate_tokens(user),
        }
    )
