"""Answer audit, session and market series queries.

Answers are sentences built from every row of ``events`` (plain ASCII, so that both regex engines
agree on word boundaries). Sessions: session = user_id, ``purchase`` = prediction, ``view`` = chat
turn. History and prompts: ``conversations``. Series: series = event_type, period = ts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog import config as C
from stratalog.bindings import SMALL_BLOCKS, query, table, utc
from stratalog.config import SeriesConfig, SessionConfig, SkewConfig
from stratalog.functions import audit_rules as R
from stratalog.functions.times import micros
from stratalog.operators import audit, series, sessions


def answers(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    k = F.lpad((F.col("event_id") % 100).cast("string"), 2, "0")
    v = F.floor("value").cast("string")
    kind = F.col("event_type")
    answer = (
        F.when(kind == "view", F.concat(
            F.lit("There is no Chalk below "), v, F.lit(" m. Marl is thick.\n")))
        .when(kind == "click", F.concat(
            F.lit("Porosity is "), v, F.lit(" and confidence of 0."), k, F.lit(" holds.")))
        .when(kind == "purchase", F.concat(
            F.lit("The reserves were not computed. Tuff and Dolomite are absent here; "), k,
            F.lit(" % confidence.")))
        .when(kind == "signup", F.concat(
            F.lit("Its confidence below 0.6 is low; probability 0."), k,
            F.lit(". The net-to-gross is high.")))
    )
    return e.select(
        F.col("event_id").alias("answer_id"),
        F.when(F.col("event_id") % 10 == 0, "What is the formula for it?")
        .otherwise("What is here?").alias("question"),
        answer.alias("answer"),
        F.when(
            F.col("user_id") % 4 != 0,
            F.concat(
                F.lit("Confidence 0."), F.lpad((F.col("user_id") % 100).cast("string"), 2, "0"),
                F.lit(" mean; nothing below 0.65."),
            ),
        ).alias("summary"),
    )


SQL_ANSWERS = """answers AS (SELECT event_id AS answer_id,
    CASE WHEN event_id % 10 = 0 THEN 'What is the formula for it?' ELSE 'What is here?' END AS question,
    CASE event_type
      WHEN 'view' THEN 'There is no Chalk below ' || v || ' m. Marl is thick.' || chr(10)
      WHEN 'click' THEN 'Porosity is ' || v || ' and confidence of 0.' || k || ' holds.'
      WHEN 'purchase' THEN 'The reserves were not computed. Tuff and Dolomite are absent here; ' || k
        || ' % confidence.'
      WHEN 'signup' THEN 'Its confidence below 0.6 is low; probability 0.' || k
        || '. The net-to-gross is high.' END AS answer,
    CASE WHEN user_id % 4 <> 0 THEN 'Confidence 0.' || lpad(CAST(user_id % 100 AS VARCHAR), 2, '0')
      || ' mean; nothing below 0.65.' END AS summary
  FROM (SELECT *, lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') AS k,
    CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS v FROM events))"""

_NEG = C.NEGATION_PATTERN.replace("'", "''")


def _sql_absence(c: str) -> str:
    return (
        rf"CASE WHEN regexp_matches(answer, '\b{_NEG}\b[^.]{{0,60}}\b{c}\b', 'i') OR "
        rf"regexp_matches(answer, '\b{c}\b[^.]{{0,40}}\b(?:{_NEG}|absent)\b', 'i') THEN '{c}' END"
    )


def _sql_quantity(q: str) -> str:
    return (
        rf"CASE WHEN regexp_matches(answer, '\d[\d.,]*\s*%?[^.]{{0,40}}\b{q}\b', 'i') OR "
        rf"regexp_matches(answer, '\b{q}\b[^.]{{0,40}}\d[\d.,]*', 'i') THEN '{q}' END"
    )


_ABSENCES = "list_filter([" + ", ".join(map(_sql_absence, C.UNRELIABLE_CLASSES)) + "], lambda x: x IS NOT NULL)"
_QUANTITIES = "list_filter([" + ", ".join(map(_sql_quantity, sorted(C.QUANTITIES))) + "], lambda x: x IS NOT NULL)"
_CONF = C.CONFIDENCE_PATTERN
SQL_FOUND = rf"""{SQL_ANSWERS}, m AS (SELECT *,
    list_transform(list_filter(regexp_extract_all(coalesce(answer, ''), '{_CONF}', 0, 'i'),
      lambda x: NOT regexp_matches(x, '{C.THRESHOLD_PATTERN}', 'i')),
      lambda x: [coalesce(nullif(regexp_extract(x, '{_CONF}', 1, 'i'), ''), regexp_extract(x, '{_CONF}', 3, 'i')),
            CASE WHEN regexp_extract(x, '{_CONF}', 1, 'i') <> '' THEN regexp_extract(x, '{_CONF}', 2, 'i')
              ELSE regexp_extract(x, '{_CONF}', 4, 'i') END]) AS raw,
    list_transform(regexp_extract_all(coalesce(summary, ''), '{C.SUMMARY_NUMBER_PATTERN}', 1),
      lambda x: round(CAST(x AS DOUBLE), 2)) AS shown FROM answers),
  n AS (SELECT *, list_transform(raw, lambda x: CASE WHEN x[2] = '%' OR CAST(x[1] AS DOUBLE) > 1
      THEN CAST(x[1] AS DOUBLE) / 100 ELSE CAST(x[1] AS DOUBLE) END) AS claimed FROM m),
  f AS (SELECT answer_id, question, answer, summary, claimed,
    len(claimed) > 0 AND summary IS NULL AS no_prediction,
    CASE WHEN summary IS NULL THEN [] ELSE list_sort(list_distinct(list_transform(list_filter(claimed,
      lambda x: NOT list_contains(shown, round(x, 2))), lambda x: printf('%.2f', x)))) END AS mismatched,
    CASE WHEN summary IS NULL OR answer IS NULL THEN [] ELSE {_ABSENCES} END AS absences,
    summary IS NOT NULL AND regexp_matches(question, '{C.FORMULA_REQUEST_PATTERN}', 'i') AS formula,
    CASE WHEN summary IS NULL OR answer IS NULL
      OR regexp_matches(question, '{C.FORMULA_REQUEST_PATTERN}', 'i') THEN [] ELSE {_QUANTITIES} END
      AS quantities FROM n)"""


@query(
    "false_absences",
    f"WITH {SQL_ANSWERS} SELECT answer_id, array_to_string({_ABSENCES}, ',') AS absences FROM answers "
    "WHERE answer IS NOT NULL",
)
def false_absences(spark: SparkSession, sf: str) -> DataFrame:
    a = answers(spark, sf).where("answer is not null")
    return a.select(
        "answer_id", F.array_join(R.false_absences(F.col("answer")), ",").alias("absences")
    )


@query(
    "unsupported_quantities",
    f"WITH {SQL_ANSWERS} SELECT answer_id, array_to_string({_QUANTITIES}, ',') AS quantities "
    "FROM answers WHERE answer IS NOT NULL",
)
def unsupported_quantities(spark: SparkSession, sf: str) -> DataFrame:
    a = answers(spark, sf).where("answer is not null")
    return a.select(
        "answer_id",
        F.array_join(R.unsupported_quantities(F.col("answer")), ",").alias("quantities"),
    )


@query(
    "formula_requests",
    f"WITH {SQL_ANSWERS} SELECT answer_id, "
    f"regexp_matches(question, '{C.FORMULA_REQUEST_PATTERN}', 'i') AS formula FROM answers",
)
def formula_requests(spark: SparkSession, sf: str) -> DataFrame:
    return answers(spark, sf).select(
        "answer_id", R.formula_request(F.col("question")).alias("formula")
    )


@query(
    "confidence_values",
    f"""WITH {SQL_FOUND} SELECT answer_id, array_to_string(list_transform(claimed,
      lambda x: CAST(CAST(round(x * 10000) AS BIGINT) AS VARCHAR)), ',') AS claimed_e4 FROM f""",
)
def confidence_values(spark: SparkSession, sf: str) -> DataFrame:
    values = F.transform(
        R.confidence_values(F.col("answer")),
        lambda c: F.round(c * 10000).cast("bigint").cast("string"),
    )
    return answers(spark, sf).select("answer_id", F.array_join(values, ",").alias("claimed_e4"))


@query(
    "confidence_check",
    f"WITH {SQL_FOUND} SELECT answer_id, no_prediction, array_to_string(mismatched, ',') AS mismatched "
    "FROM f",
)
def confidence_check(spark: SparkSession, sf: str) -> DataFrame:
    found = audit.findings(answers(spark, sf))
    return found.select(
        "answer_id", "no_prediction", F.array_join("mismatched", ",").alias("mismatched")
    )


def _sql_fill(note: str, value: str) -> str:
    head, rest = note.replace("'", "''").split("{}")
    return f"'{head}' || array_to_string({value}, ', ') || '{rest}'"


_NOTES = f"""list_filter([
    CASE WHEN no_prediction THEN '{C.NOTE_NO_PREDICTION}'
      WHEN len(mismatched) > 0 THEN {_sql_fill(C.NOTE_CONFIDENCE, 'mismatched')} END,
    CASE WHEN len(absences) = 1 THEN {_sql_fill(C.NOTE_ABSENCE_ONE, 'absences')}
      WHEN len(absences) > 1 THEN {_sql_fill(C.NOTE_ABSENCE_MANY, 'absences')} END,
    CASE WHEN len(quantities) > 0 THEN {_sql_fill(C.NOTE_QUANTITIES, 'quantities')} END],
    lambda x: x IS NOT NULL)"""


@query(
    "corrected_answers",
    rf"""WITH {SQL_FOUND}, t AS (SELECT *, {_NOTES} AS notes FROM f)
    SELECT answer_id, CASE WHEN answer IS NULL THEN coalesce(summary, '{C.ANSWER_UNAVAILABLE}')
      WHEN len(notes) = 0 THEN answer
      ELSE regexp_replace(answer, '\s+$', '') || chr(10) || chr(10) ||
        array_to_string(notes, chr(10) || chr(10)) END AS answer,
      CAST(CASE WHEN answer IS NULL THEN 1 ELSE len(notes) END AS BIGINT) AS n_warnings FROM t""",
)
def corrected_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Missing answers fall back first and are then left alone by the rules."""
    done = audit.corrected(audit.with_fallback(answers(spark, sf)))
    return done.select(
        "answer_id", "answer", F.size("warnings").cast("bigint").alias("n_warnings")
    )


@query(
    "answer_fallback",
    f"""WITH {SQL_ANSWERS} SELECT answer_id, answer IS NOT NULL AS llm_used,
      coalesce(answer, summary, '{C.ANSWER_UNAVAILABLE}') AS answer,
      CASE WHEN answer IS NULL THEN '{C.WARNING_UNAVAILABLE}' ELSE '' END AS warnings FROM answers""",
)
def answer_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return audit.with_fallback(answers(spark, sf)).select(
        "answer_id", "llm_used", "answer", F.array_join("warnings", ",").alias("warnings")
    )


@query(
    "audit_totals",
    f"""WITH {SQL_FOUND}, t AS (SELECT unnest([
      CASE WHEN no_prediction THEN 'guard: confidence claimed with no prediction'
        WHEN len(mismatched) > 0 THEN 'guard: mismatched confidence' END,
      CASE WHEN len(absences) > 0 THEN 'guard: corrected absence claim' END,
      CASE WHEN formula THEN 'guard: skipped quantity check (formula request)'
        WHEN len(quantities) > 0 THEN 'guard: flagged fabricated quantities' END]) AS rule
      FROM f WHERE answer IS NOT NULL)
    SELECT replace(rule, ' (formula request)', '') AS rule, count(*) AS n FROM t
    WHERE rule IS NOT NULL GROUP BY 1""",
)
def audit_totals(spark: SparkSession, sf: str) -> DataFrame:
    return audit.totals(audit.corrected(audit.with_fallback(answers(spark, sf))))


# --- sessions -------------------------------------------------------------------------------


def session_events(spark: SparkSession, sf: str) -> DataFrame:
    return session_rows(table(spark, sf, "events").withColumn("ts", utc("ts")))


def session_rows(e: DataFrame) -> DataFrame:
    """A prediction has value modulo 3 zones; without zones it has no class."""
    kind = F.when(F.col("event_type") == "purchase", "prediction").when(
        F.col("event_type") == "view", "chat"
    ).otherwise("other")
    n = F.floor(F.col("value") % 3).cast("bigint")
    made = F.col("event_type") == "purchase"
    return e.select(
        "event_id",
        F.col("user_id").alias("session_id"),
        "ts",
        kind.alias("kind"),
        F.when(made, F.concat(F.lit("w"), F.col("event_id"))).alias("well_name"),
        F.when(made, F.concat(F.lit("summary "), F.col("event_id"))).alias("summary"),
        F.when(made, n).alias("n_zones"),
        F.when(made & (n > 0), F.concat(F.lit("class "), n)).alias("dominant_lithology"),
    )


SQL_STARTS = """RECURSIVE ev AS (SELECT event_id, user_id AS session_id, epoch_us(ts) AS t, event_type,
    value FROM events),
  st AS (SELECT session_id, min(t) AS t FROM ev GROUP BY session_id
    UNION ALL SELECT st.session_id, min(ev.t) FROM st JOIN ev ON ev.session_id = st.session_id
      AND ev.t > st.t + 14400000000 GROUP BY st.session_id)"""
SQL_CONTEXT = f"""{SQL_STARTS},
  pl AS (SELECT ev.*, st.t AS created_us FROM ev ASOF JOIN st ON ev.session_id = st.session_id
    AND ev.t >= st.t),
  cx AS (SELECT *, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER w
      AS at_id, last_value(CASE WHEN event_type = 'purchase' THEN CAST(floor(value % 3) AS BIGINT) END
      IGNORE NULLS) OVER w AS nz FROM pl
    WINDOW w AS (PARTITION BY session_id, created_us ORDER BY t, event_id ROWS UNBOUNDED PRECEDING))"""


@query(
    "session_starts",
    f"WITH {SQL_STARTS} SELECT session_id, t AS created_us FROM st",
)
def session_starts(spark: SparkSession, sf: str) -> DataFrame:
    created = sessions.sessions(session_events(spark, sf))
    return created.select("session_id", micros("created_at").alias("created_us"))


@query(
    "session_cap",
    f"""WITH {SQL_STARTS} SELECT session_id, t AS created_us FROM st
    WHERE (SELECT max(t) FROM ev) - t BETWEEN 0 AND 1209600000000
    ORDER BY t DESC, session_id LIMIT 500""",
)
def session_cap(spark: SparkSession, sf: str) -> DataFrame:
    """Alive at the last event with a lifetime of 14 days for the cap, so that it is reached."""
    ev = session_events(spark, sf)
    created = sessions.sessions(ev)
    alive = sessions.live_sessions(
        created, ev.select(F.max("ts")).scalar(), SessionConfig(ttl_seconds=14 * 86400)
    )
    return alive.select("session_id", micros("created_at").alias("created_us"))


#: a cap that the given tables reach: some hundred events a day over 15 users for each 1,000 events
SMALL_CAP = SessionConfig(max_sessions=8)

# one event after the other: the sessions alive are a map from user to (creation, number of it), and one
# is gone when it is too old or the creations after it number the cap when an event comes
SQL_CAPPED = f"""RECURSIVE ev AS MATERIALIZED (SELECT event_id, user_id AS u, epoch_us(ts) AS t, event_type,
      row_number() OVER (ORDER BY ts, event_id) AS i FROM events),
  run AS (SELECT 0::BIGINT AS i, 0::BIGINT AS n, MAP {{}}::MAP(BIGINT, STRUCT(c BIGINT, r BIGINT)) AS live,
      false AS opens, 0::BIGINT AS c
    UNION ALL SELECT i, n + opens::BIGINT, CASE WHEN opens THEN map_concat(live, MAP {{u: {{'c': t, 'r': n + 1}}}}) ELSE live END,
      opens, CASE WHEN opens THEN t ELSE live[u].c END
    FROM (SELECT ev.i, ev.u, ev.t, run.n, run.live, coalesce(ev.t - run.live[ev.u].c > 14400000000
        OR run.n - run.live[ev.u].r >= {SMALL_CAP.max_sessions}, true) AS opens FROM run JOIN ev ON ev.i = run.i + 1)),
  seen AS (SELECT ev.*, run.c AS created_us, run.opens, run.n FROM run JOIN ev USING (i))"""


@query(
    "session_evictions",
    f"""WITH {SQL_CAPPED}, made AS (SELECT u, t, n, i FROM seen WHERE opens)
    SELECT made.u AS session_id, made.t AS created_us, ev.t AS ended_us FROM made
      JOIN made AS late ON late.n = made.n + {SMALL_CAP.max_sessions} JOIN ev ON ev.i = late.i + 1
    WHERE ev.t - made.t <= 14400000000""",
)
def session_evictions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions that a cap of eight ends before their four hours are over; blocks of 1,000 events."""
    gone = sessions.evictions(session_events(spark, sf), ["ts", "event_id"], SMALL_CAP, SkewConfig(max_rows=1_000))
    return gone.select("session_id", micros("created_at").alias("created_us"), micros("ended_at").alias("ended_us"))


@query(
    "session_context_capped",
    f"""WITH {SQL_CAPPED}, cx AS (SELECT *, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS)
      OVER w AS at_id FROM seen WINDOW w AS (PARTITION BY u, created_us ORDER BY i ROWS UNBOUNDED PRECEDING))
    SELECT event_id, u AS session_id, created_us, at_id IS NOT NULL AS has_context, 'w' || at_id AS well_name FROM cx""",
)
def session_context_capped(spark: SparkSession, sf: str) -> DataFrame:
    """Context of every event where the cap ends sessions; what came before in them is forgotten."""
    seen = sessions.with_capped_context(
        session_events(spark, sf), ["ts", "event_id"], SMALL_CAP, SkewConfig(max_rows=1_000)
    )
    return seen.select("event_id", "session_id", micros("created_at").alias("created_us"), "has_context", "well_name")


SQL_SESSION_CONTEXT = f"""WITH {SQL_CONTEXT} SELECT event_id, session_id, created_us, at_id IS NOT NULL
      AS has_context, 'w' || at_id AS well_name, 'summary ' || at_id AS summary, nz AS n_zones,
      CASE WHEN nz > 0 THEN 'class ' || nz END AS dominant_lithology FROM cx"""


@query("session_context", SQL_SESSION_CONTEXT)
def session_context(spark: SparkSession, sf: str, skew: SkewConfig = SkewConfig()) -> DataFrame:
    seen = sessions.with_context(session_events(spark, sf), ["ts", "event_id"], skew=skew)
    return seen.select(
        "event_id", "session_id", micros("created_at").alias("created_us"), "has_context",
        "well_name", "summary", "n_zones", "dominant_lithology",
    )


@query("session_context_blocks", SQL_SESSION_CONTEXT)
def session_context_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same, every session cut into blocks as a hot one would be."""
    return session_context(spark, sf, SMALL_BLOCKS)


@query(
    "attached_predictions",
    f"""WITH {SQL_CONTEXT} SELECT session_id, created_us, count(*) FILTER (WHERE event_type = 'purchase')
      AS n_predictions, 'w' || max(CASE WHEN event_type = 'purchase' THEN event_id END) AS well_name,
      arg_max(nz, t) AS n_zones,
      CASE WHEN arg_max(nz, t) > 0 THEN 'class ' || arg_max(nz, t) END AS dominant_lithology
      FROM cx GROUP BY session_id, created_us""",
)
def attached_predictions(spark: SparkSession, sf: str) -> DataFrame:
    final = sessions.attached(session_events(spark, sf), ["ts", "event_id"])
    return final.select(
        "session_id", micros("created_at").alias("created_us"), "n_predictions", "well_name", "n_zones",
        "dominant_lithology",
    )


@query(
    "session_info",
    f"""WITH {SQL_CONTEXT} SELECT session_id, count(*) FILTER (WHERE event_type = 'purchase') > 0
      AS has_well_context, 'w' || max(CASE WHEN event_type = 'purchase' THEN event_id END) AS well_name,
      arg_max(nz, t) AS n_zones,
      strftime(make_timestamp(created_us), '%Y-%m-%dT%H:%M:%SZ') AS created_at
      FROM cx GROUP BY session_id, created_us""",
)
def session_info(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.session_info(
        sessions.attached(session_events(spark, sf), ["ts", "event_id"])
    )


SQL_HISTORY = r"""h AS (SELECT conv_id, turn, role, text, string_agg(
      CASE WHEN role = 'user' THEN 'User: ' ELSE 'Assistant: ' END ||
      regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', ''), chr(10)) OVER (PARTITION BY conv_id
      ORDER BY turn ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS lines
    FROM conversations WHERE role IN ('user', 'assistant')),
  hist AS (SELECT conv_id, turn, role, text, 'Earlier in this conversation:' || chr(10) || lines AS history
    FROM h)"""


@query("history_window", f"WITH {SQL_HISTORY} SELECT conv_id, turn, history FROM hist")
def history_window(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.history(table(spark, sf, "conversations")).select("conv_id", "turn", "history")


@query("history_window_blocks", f"WITH {SQL_HISTORY} SELECT conv_id, turn, history FROM hist")
def history_window_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same, with conversations cut into blocks of about two turns."""
    turns = table(spark, sf, "conversations")
    return sessions.history(turns, skew=SkewConfig(max_rows=2)).select("conv_id", "turn", "history")


_SYSTEM = "You are a geologist."
_SEP = "chr(10) || chr(10) || '---' || chr(10) || chr(10)"
_RULES = C.LITHOLOGY_RULES.replace("'", "''")
_CONTEXT_A, _CONTEXT_B = C.CONTEXT_FRAME.replace("'", "''").split("{}")


@query(
    "prompt_budget",
    rf"""WITH {SQL_HISTORY}, q AS (SELECT *, CASE WHEN conv_id % 2 = 0 THEN 'Well ' || conv_id END
        AS summary FROM hist),
      b AS (SELECT *, coalesce('{_CONTEXT_A}' || summary || '{_CONTEXT_B}' || {_SEP}, '') AS c,
        '{_SYSTEM}' || chr(10) || chr(10) || 'Question: ' ||
        regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '') AS asked FROM q),
      f AS (SELECT *, c || coalesce(history || {_SEP}, '') || asked AS full_, c || asked AS bare FROM b)
    SELECT conv_id, turn, length(full_) // 4 > 700 AND history IS NOT NULL AS trimmed,
      length(CASE WHEN length(full_) // 4 > 700 THEN bare ELSE full_ END) // 4 > 700 AS over_budget,
      CASE WHEN length(full_) // 4 > 700 THEN bare ELSE full_ END ||
      CASE WHEN summary IS NOT NULL THEN chr(10) || chr(10) || '{_RULES}' ELSE '' END AS message
    FROM f""",
)
def prompt_budget(spark: SparkSession, sf: str) -> DataFrame:
    """Every second conversation has a summary."""
    h = sessions.history(table(spark, sf, "conversations")).select(
        "conv_id", "turn", F.col("text").alias("question"), "history",
        F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("Well "), F.col("conv_id")))
        .alias("summary"),
    )
    return sessions.message(h, _SYSTEM).select(
        "conv_id", "turn", "trimmed", "over_budget", "message"
    )


@query(
    "routing",
    """SELECT conv_id, turn, CASE WHEN turn = 0 AND conv_id % 3 = 0 THEN 'lithology' ELSE 'chat' END
      AS route, CASE WHEN NOT (turn = 0 AND conv_id % 3 = 0) AND conv_id % 2 = 0 THEN 'Well ' || conv_id
      END AS summary FROM conversations""",
)
def routing(spark: SparkSession, sf: str) -> DataFrame:
    """The first turn of every third conversation brings a file."""
    c = table(spark, sf, "conversations").select(
        "conv_id", "turn",
        F.when((F.col("turn") == 0) & (F.col("conv_id") % 3 == 0), F.lit("a.las")).alias("file"),
        F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("Well "), F.col("conv_id")))
        .alias("prior_summary"),
    )
    return sessions.route(c).select("conv_id", "turn", "route", "summary")


_SHOWN = C.SHOWN_FRAME.replace("'", "''").split("{}")


@query(
    "answer_prompts",
    rf"""WITH q AS (SELECT conv_id, turn, regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '')
        AS asked, CASE WHEN conv_id % 2 = 0 THEN 'Well ' || conv_id END AS summary
        FROM conversations WHERE role = 'user'),
      p AS (SELECT *, CASE WHEN summary IS NULL THEN asked ELSE '{_SHOWN[0]}' || summary || '{_SHOWN[1]}'
        || asked END AS user_ FROM q)
    SELECT conv_id, turn, '{_SYSTEM}' || CASE WHEN summary IS NULL THEN '' ELSE chr(10) || chr(10) ||
      '{_RULES}' END AS system, user_ AS user, CAST(length(user_) // 4 AS BIGINT) AS prompt_tokens FROM p""",
)
def answer_prompts(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations").where("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("question"),
        F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("Well "), F.col("conv_id")))
        .alias("summary"),
    )
    return sessions.answer_prompt(c, _SYSTEM).select(
        "conv_id", "turn", "system", "user", "prompt_tokens"
    )


# --- market series --------------------------------------------------------------------------

QUOTED = SeriesConfig(wti="view", brent="click")


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """The values of ``error`` and ``signup`` are missing."""
    e = table(spark, sf, "events")
    return e.select(
        "event_id",
        F.col("event_type").alias("series"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("period"),
        F.when(~F.col("event_type").isin("error", "signup"), F.col("value")).alias("value"),
    )


SQL_LATEST = """latest AS (SELECT event_type AS series, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS period,
    arg_max(CASE WHEN event_type NOT IN ('error', 'signup') THEN {'v': value} ELSE {'v': NULL} END, ts).v
      AS value FROM events GROUP BY 1)"""


@query(
    "latest_values",
    f"""WITH {SQL_LATEST} SELECT series, period, value,
      CASE WHEN value IS NULL THEN 'incomplete row for series ' || series END AS error FROM latest""",
)
def latest_values(spark: SparkSession, sf: str) -> DataFrame:
    return series.latest(observations(spark, sf))


@query(
    "incomplete_series",
    """SELECT w.series, CASE WHEN e.event_type IS NULL THEN 'no data for series ' || w.series
      ELSE 'incomplete row for series ' || w.series END AS error
    FROM (SELECT DISTINCT event_type AS series FROM events UNION SELECT n_name FROM nation) w
    LEFT JOIN (SELECT DISTINCT event_type FROM events) e ON e.event_type = w.series
    WHERE e.event_type IS NULL OR e.event_type IN ('error', 'signup')""",
)
def incomplete_series(spark: SparkSession, sf: str) -> DataFrame:
    """Wanted are all event types, and the nation names, of which there is no data."""
    obs = observations(spark, sf)
    wanted = obs.select("series").union(
        table(spark, sf, "nation").select(F.col("n_name").alias("series"))
    ).distinct()
    return series.latest_checked(obs, wanted)[1]


@query(
    "price_quote",
    f"""WITH {SQL_LATEST} SELECT max(value) FILTER (WHERE series = 'view') AS wti_usd,
      max(period) FILTER (WHERE series = 'view') AS wti_date,
      max(value) FILTER (WHERE series = 'click') AS brent_usd,
      max(period) FILTER (WHERE series = 'click') AS brent_date FROM latest""",
)
def price_quote(spark: SparkSession, sf: str) -> DataFrame:
    obs = observations(spark, sf)
    wanted = obs.select("series").distinct()
    return series.quote(series.latest_checked(obs, wanted)[0], QUOTED)


@query(
    "quote_line",
    f"""WITH {SQL_LATEST} SELECT 'WTI: $' || printf('%.2f', max(value) FILTER (WHERE series = 'view'))
      || '/bbl (as of ' || max(period) FILTER (WHERE series = 'view') || '), Brent: $' ||
      printf('%.2f', max(value) FILTER (WHERE series = 'click')) || '/bbl (as of ' ||
      max(period) FILTER (WHERE series = 'click') || ')' AS line FROM latest""",
)
def quote_line(spark: SparkSession, sf: str) -> DataFrame:
    return series.quote_line(price_quote(spark, sf))


@query(
    "served_values",
    """WITH RECURSIVE ev AS (SELECT event_id, event_type AS series, epoch_us(ts) AS t, value >= 20 AS ok,
        value FROM events),
      g AS (SELECT series, t FROM ev WHERE ok),
      st AS (SELECT series, min(t) AS t FROM g GROUP BY series
        UNION ALL SELECT st.series, min(g.t) FROM st JOIN g ON g.series = st.series
          AND g.t > st.t + 3600000000 GROUP BY st.series),
      sv AS (SELECT st.series, st.t, ev.value FROM st JOIN ev ON ev.series = st.series AND ev.t = st.t
        AND ev.ok),
      j AS (SELECT ev.*, sv.t AS st, sv.value AS sv FROM ev ASOF LEFT JOIN sv
        ON ev.series = sv.series AND ev.t >= sv.t)
    SELECT event_id, series, ok, sv AS served_value, st AS served_us,
      CASE WHEN st IS NULL THEN 'failed' WHEN t - st > 3600000000 THEN 'stale'
        WHEN t = st THEN 'refreshed' ELSE 'cached' END AS state FROM j""",
)
def served_values(spark: SparkSession, sf: str) -> DataFrame:
    """Every event is a request; a value below 20 stands for a failed fetch."""
    e = table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("series"),
        utc("ts").alias("fetched_at"),
        (F.col("value") >= 20).alias("ok"),
        "value",
    )
    out = series.served(e, ["series"], ["fetched_at", "event_id"])
    return out.select(
        "event_id", "series", "ok", "served_value", micros("served_at").alias("served_us"), "state"
    )
