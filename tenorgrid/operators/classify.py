"""Free-text questions to outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenorgrid.functions.text import normalise_text
from tenorgrid.functions.values import lookup

# Phrases and patterns that place a question in a family.
DISSENT = "dissent"
COMBO = "fomc decision result in"
COMBO_PATTERN = r"result in (no change|a 25bp cut|any other outcome) ?(?:with (<=2|>2|<2|>=2) dissents)?"
COMBO_LEGS = {"no change": "HOLD", "a 25bp cut": "CUT25", "any other outcome": "OTHER"}
PATH_PHRASES = ["next three decisions", "decide differently"]
PATH_PATTERN = r"\b(cut|pause|hike)-(cut|pause|hike)-(cut|pause|hike)\b"
FAVOURED = "favored for fed decision"
CATCH_ALL = "change rates to another level"
THRESHOLD = "set interest rates above"
THRESHOLD_LEVEL = r"above ([0-9.]+)%"
THRESHOLD_SIZE = r"\((\d+) bps or more\)"
NO_CHANGE = r"\bno change\b"
CUT_SIZE = r"\b(decrease|decreases|cut|cuts|lower|lowers)\b.*?\bby (\d+)(\+?) ?bps?"
HIKE_SIZE = r"\b(increase|increases|raise|raises|hike|hikes)\b.*?\bby (\d+)(\+?) ?bps?"
# Outcome, detail and note of each kind of question. A detail of None is read from the text.
KINDS = {
    "combo": ("OTHER", None, "decision x dissent combo"),
    "dissent": ("OTHER", "DISSENT_INDIVIDUAL", "individual dissent market"),
    "path": ("OTHER", None, "three-decision path market"),
    "path_other": ("OTHER", "PATH_OTHER", "three-decision path catch-all"),
    "favoured": ("OTHER", "ODDS_FAVORED_2WAY", "which-leg-favored market; outcomes are not Yes/No"),
    "catch_all": ("OTHER", "CATCHALL_OTHER_LEVEL", "residual catch-all leg"),
    "threshold": ("OTHER", None, "cumulative threshold market (not a single-size bucket)"),
    "hold": ("HOLD", "HOLD", None),
    "cut25": ("CUT25", "CUT25", None),
    "cut25p": ("OTHER", "CUT25P", "cut 25+ spans CUT25 and CUT50P"),
    "cut50": ("CUT50P", None, None),
    "cut_odd": ("OTHER", None, "unusual cut size"),
    "hike0": ("HOLD", "HOLD_0BP", None),
    "hike25": ("HIKE25", "HIKE25", None),
    "hike25p": ("HIKE50P", "HIKE25P",
                "'25+ bps hike' leg (any hike) mapped to HIKE50P per canonical rule; detail=HIKE25P"),
    "hike50": ("HIKE50P", None, None),
    "hike_odd": ("OTHER", None, "unusual hike size"),
    "unmapped": ("OTHER", "UNMAPPED", "ambiguous question text"),
}


def _family(s: Column) -> Column:
    """First family whose phrase or pattern the text has.

    Each pattern is preceded by a plain substring that any match must contain, which is far cheaper on long text.
    """
    return (F.when(s.contains(COMBO), "combo")
            .when(s.contains(DISSENT), "dissent")
            .when(s.contains("-") & s.rlike(PATH_PATTERN), "path")
            .when(s.contains(PATH_PHRASES[0]) | s.contains(PATH_PHRASES[1]), "path_other")
            .when(s.contains(FAVOURED), "favoured")
            .when(s.contains(CATCH_ALL), "catch_all")
            .when(s.contains(THRESHOLD), "threshold")
            .when(s.contains("no change") & s.rlike(NO_CHANGE), "hold")
            .when(s.contains("bp") & s.rlike(CUT_SIZE), "cut")
            .when(s.contains("bp") & s.rlike(HIKE_SIZE), "hike")
            .when(s.isNotNull(), "unmapped"))


def _kind(family: Column, n: Column, plus: Column) -> Column:
    """Family refined by the size of the move: exactly 25, 25 or more, 50 and beyond, or another size."""
    sized = F.when((n == 25) & ~plus, "25").when(n == 25, "25p").when(n >= 50, "50").otherwise("_odd")
    return (F.when((family == "hike") & (n == 0), "hike0")
            .when(family.isin("cut", "hike"), F.concat(family, sized))
            .otherwise(family))


def classify_questions(df: DataFrame, text: str) -> DataFrame:
    """Add ``outcome``, ``detail`` and ``note`` of a free-text question.

    The steps are separate projections: each reads the columns of the one before, so no pattern is evaluated
    twice and the generated code of each step stays small.
    """
    s, family, kind = F.col("__s"), F.col("__family"), F.col("__kind")
    part = lambda pattern, i: F.regexp_extract(s, pattern, i)
    sized = lambda i: F.when(family == "cut", part(CUT_SIZE, i)).when(family == "hike", part(HIKE_SIZE, i))
    rows = df.withColumn("__s", normalise_text(text)).withColumn("__family", _family(s))
    rows = rows.withColumns({"__n": sized(2).try_cast("bigint"), "__plus": sized(3) == "+"})
    rows = rows.withColumn("__kind", _kind(family, F.col("__n"), F.col("__plus")))

    tail = lambda prefix, c, suffix="": F.when(c != "", F.concat(F.lit(prefix), c, F.lit(suffix))).otherwise("")
    combo = F.concat(F.lit("COMBO_"), lookup(part(COMBO_PATTERN, 1), COMBO_LEGS, "UNK"), tail("_DISSENT", part(COMBO_PATTERN, 2)))
    path = F.concat(F.lit("PATH_"), F.upper(F.concat_ws("_", *(part(PATH_PATTERN, i) for i in (1, 2, 3)))))
    threshold = F.concat(F.lit("THRESHOLD_ABOVE"), tail("_", part(THRESHOLD_LEVEL, 1), "PCT"), tail("_HIKE_GE", part(THRESHOLD_SIZE, 1)))
    move = F.concat(F.upper(family), F.col("__n").cast("string"), F.when(F.col("__plus"), "P").otherwise(""))
    read = (F.when(kind == "combo", combo).when(kind == "path", path).when(kind == "threshold", threshold)
            .when(family.isin("cut", "hike"), move))
    field = lambda i: {k: v[i] for k, v in KINDS.items() if v[i] is not None}
    return rows.withColumns({
        "outcome": lookup(kind, field(0)), "detail": F.coalesce(lookup(kind, field(1)), read), "note": lookup(kind, field(2)),
    }).drop("__s", "__family", "__n", "__plus", "__kind")
