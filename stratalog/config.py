"""Parameters of the operators.

The literals below are fixed values: results only agree with the behaviour users expect when they
are exactly these. Everything else is a tunable default.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: corpus filters -----------------------------------------------------------
KEEP_TYPES = ("geo", "geoqa", "self")
DROP_CATEGORY_PREFIXES = ("gso.wikipedia.", "gso.wordnet.")
DROP_INSTRUCTION_PATTERN = r"related paper"
BROKEN_OUTPUT_PATTERN = r"\b(?:is|means) that \d+\b"
PLACEHOLDER_OUTPUT_PATTERN = r"no corresponding information"
SYSTEM_PROMPT = "You are an expert geologist specializing in Earth Sciences."
ROLES = ("system", "user", "assistant")

# --- fixed values: token lengths ------------------------------------------------------------
TOKEN_PERCENTILES = (50, 75, 90, 95, 99, 99.5, 99.9)
TOKEN_CAPS = (512, 1024, 1536, 2048, 3072, 4096)

# --- fixed values: domain keywords (substring match on the lower-cased question) -------------
DOMAIN_KEYWORDS = (
    "reservoir", "petroleum", "oil", "gas", "source rock", "seal", "trap",
    "stratigraph", "sequence", "facies", "depositional", "sediment",
    "well log", "wireline", "gamma ray", "porosity", "permeability",
    "seismic", "structural", "fault", "basin", "migration", "maturation",
    "turbidite", "fluvial", "deltaic", "carbonate", "clastic",
    "cuenca", "reservorio", "estratigraf", "sismica", "petrol",
)

# --- fixed values: well logs ----------------------------------------------------------------
NULL_SENTINELS = (-999.25, -999.9, -999.0)
REQUIRED_CURVES = ("GR", "RDEP", "RMED", "RHOB", "NPHI", "DTC", "CALI", "DRHO")
PLOT_CURVES = ("GR", "RDEP", "RHOB", "NPHI", "DTC")
UNRELIABLE_CLASSES = ("Chalk", "Tuff", "Marl", "Dolomite")
UPLOAD_EXTENSIONS = (".las", ".csv")
MAX_UPLOAD_BYTES = 50 * 1024 * 1024

# sentences of a well's summary
SUMMARY_HEADER = "Well %s — logged %.1f–%.1f m MD (%d samples, %d zones)."
SUMMARY_TOTAL = "  %-17s %8.1f m (%5s)"
SUMMARY_ZONE = "  %7.1f–%7.1f m %7.1f m %-17s conf %.2f"
SUMMARY_CAUTION = "CAUTION: "
SUMMARY_NO_ZONES = "No lithology zones were resolved."
SUMMARY_TOTALS_TITLE = "\nLithology totals:\n"
SUMMARY_ZONES_TITLE = "\n\nThickest zones (top %d):\n"
SUMMARY_CONFIDENCE = "\n\nConfidence %.2f mean (thickness-weighted); "
SUMMARY_UNCERTAIN = " of the column is below {} and should be treated as uncertain.\n"
SUMMARY_BLIND_SPOTS = "Model blind spots — NOT reliably detected, so do not state their absence as fact: {}."
SUMMARY_REFUSED = ("Well ", ": prediction REFUSED. ")

# (id, well name, label, description, top, base)
SAMPLE_WELLS = (
    ("25_5-1", "25/5-1", "North Sea 25/5-1", "Sandstone Reservoir", 145.0, 3432.0),
    ("17_11-1", "17/11-1", "North Sea 17/11-1", "Shale / Evaporite Sequence", 148.0, 3269.0),
)

# --- fixed values: answer audit -------------------------------------------------------------
NEGATION_PATTERN = (
    r"(?:no|not|none|without|absent|absence of|lacks?|free of|didn't|did not|isn't|is not|wasn't|was not)"
)
# {} are the negations, the class, and the widths of the gaps
ABSENCE_PATTERNS = (r"\b{negation}\b[^.]{{0,{gap}}}\b{name}\b", r"\b{name}\b[^.]{{0,{gap}}}\b(?:{negation}|absent)\b")
QUANTITY_PATTERNS = (r"\d[\d.,]*\s*%?[^.]{{0,{gap}}}\b{name}\b", r"\b{name}\b[^.]{{0,{gap}}}\d[\d.,]*")
QUANTITIES = (
    "porosity", "permeability", "saturation", "api gravity", "net pay", "net-to-gross",
    "net to gross", "toc", "water cut", "pore pressure", "reserves", "flow rate", "viscosity",
)
FORMULA_REQUEST_PATTERN = (
    r"\b(equation|formula|how (?:do you|is it) calculat(?:e|ing|ion)?|how to calculate|"
    r"derive|what is the (?:equation|formula)|worked example)\b"
)
CONFIDENCE_PATTERN = (
    r"\b(?:confidence|probability|certainty)\b[^.\n]{0,30}?(\d\d?\d?(?:\.\d+)?)\s*(%?)"
    r"|(\d\d?\d?(?:\.\d+)?)\s*(%?)[^.\n]{0,20}?\b(?:confidence|probability|certainty)\b"
)
THRESHOLD_PATTERN = (
    r"\b(?:below|above|under|over|less than|greater than|at least|at most|"
    r"exceeds?|threshold|beneath)\b"
)
SUMMARY_NUMBER_PATTERN = r"\b(0\.\d+|1\.0+)\b"
NOTE_NO_PREDICTION = (
    "Correction: no well log has been analysed in this session, so the "
    "confidence figures above were not produced by the lithology model. "
    "Disregard them and upload a log to get a real prediction."
)
NOTE_CONFIDENCE = (
    "Correction: the confidence values {} do not appear in this well's "
    "prediction. Trust the measured result above, not these figures. "
)
NOTE_ABSENCE_ONE = (
    "Correction: this model cannot detect {}. Its absence from the result "
    "is a limitation of the model, not evidence that it is absent from the well."
)
NOTE_ABSENCE_MANY = (
    "Correction: this model cannot detect {}. Their absence from the "
    "result is a limitation of the model, not evidence that they are absent "
    "from the well."
)
NOTE_QUANTITIES = (
    "Correction: the lithology model provides only rock type, depth and "
    "confidence. It has no {} data."
)
WARNING_UNAVAILABLE = (
    "The geologist assistant is unavailable, so the raw model output is shown below."
)
ANSWER_UNAVAILABLE = (
    "The geologist assistant is currently not available. Please try again."
)

# --- fixed values: prompt frames ------------------------------------------------------------
CONTEXT_FRAME = (
    "Lithology prediction for the uploaded well log:\n\n{}\n\n"
    "Answer the user's question using only this result."
)
SHOWN_FRAME = (
    "Lithology prediction for the uploaded well log:\n\n{}\n\n"
    "This table has already been shown to the user, so do not repeat it.\n\n"
    "Question: {}"
)
HISTORY_FRAME = "Earlier in this conversation:\n{}"
BLOCK_SEPARATOR = "\n\n---\n\n"
LITHOLOGY_RULES = """Rules for lithology results:
- They come from an XGBoost model. Report them as predictions, never as
  secure established fact. Say "the model predicts", not "the well contains".
- Confidence below 0.6 is uncertain — say so rather than presenting it flatly.
- The model does not reliably detect Chalk, Tuff, Marl or Dolomite. If asked
  about these, say the model cannot determine them. Never report them as absent.
- If a prediction is refused, explain why in plain language."""

# --- fixed values: market series ------------------------------------------------------------
WTI_SERIES = "RWTC"
BRENT_SERIES = "RBRTE"


@dataclass(frozen=True)
class SkewConfig:
    """When a key counts as hot: with more rows than one task should order.

    Hot keys are cut into blocks of at most ``max_rows`` rows, so the number of blocks of a key follows
    its number of rows. One task orders about ``task_rows`` rows of them, or ``max_rows`` if that is more.
    """

    max_rows: int = 1_000_000
    task_rows: int = 1_000_000


@dataclass(frozen=True)
class CleanConfig:
    types: tuple[str, ...] = KEEP_TYPES
    drop_prefixes: tuple[str, ...] = DROP_CATEGORY_PREFIXES
    instruction_pattern: str | None = DROP_INSTRUCTION_PATTERN
    broken_pattern: str | None = BROKEN_OUTPUT_PATTERN
    placeholder_pattern: str | None = PLACEHOLDER_OUTPUT_PATTERN
    min_output: int = 15
    max_output: int = 2500


@dataclass(frozen=True)
class ChatTemplate:
    """Pieces of a chat template; the token measure depends on them."""

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    after_content: str = "<|im_end|>\n"
    generation: str = "<|im_start|>assistant\n"


@dataclass(frozen=True)
class TokenConfig:
    percentiles: tuple[float, ...] = TOKEN_PERCENTILES
    caps: tuple[int, ...] = TOKEN_CAPS
    coverage: float = 99.0
    max_tokens: int = 1024


@dataclass(frozen=True)
class MixConfig:
    seed: int = 42
    filter_val_fraction: float = 0.02
    merge_val_fraction: float = 0.03
    min_answer: int = 10
    factor: int = 5
    subset: int = 450


@dataclass(frozen=True)
class EvalConfig:
    patience: int = 3
    credits_per_hour: float = 9.0
    question_chars: int = 150
    answer_chars: int = 200


@dataclass(frozen=True)
class WellConfig:
    required: tuple[str, ...] = REQUIRED_CURVES
    optional: tuple[str, ...] = ()
    plot_curves: tuple[str, ...] = PLOT_CURVES
    min_thickness: float = 0.5
    max_zones: int = 8
    low_confidence: float = 0.65
    plot_points: int = 600
    blind_recall: float = 0.1
    unreliable: tuple[str, ...] = UNRELIABLE_CLASSES


@dataclass(frozen=True)
class DriftConfig:
    """The rule is ours: a curve is flagged when too many samples leave the training range."""

    low: float = 0.01
    high: float = 0.99
    max_outside: float = 0.25
    refuse_at: int = 3
    # rank error 1 in this many rows; also bounds the sketch each task holds
    accuracy: int = 100_000
    # size of the mergeable sketches: rank error about 0.0007; exact up to as many samples
    sketch_k: int = 8192


@dataclass(frozen=True)
class AuditConfig:
    classes: tuple[str, ...] = UNRELIABLE_CLASSES
    negation: str = NEGATION_PATTERN
    quantities: tuple[str, ...] = QUANTITIES
    before: int = 60
    after: int = 40
    digit_window: int = 40
    formula: str = FORMULA_REQUEST_PATTERN
    confidence: str = CONFIDENCE_PATTERN
    threshold: str = THRESHOLD_PATTERN
    summary_number: str = SUMMARY_NUMBER_PATTERN


@dataclass(frozen=True)
class SessionConfig:
    ttl_seconds: int = 4 * 3600
    max_sessions: int = 500
    history_turns: int = 3
    max_prompt_tokens: int = 700


@dataclass(frozen=True)
class SeriesConfig:
    ttl_seconds: int = 3600
    wti: str = WTI_SERIES
    brent: str = BRENT_SERIES
