"""Values and states from the text logs of external scoring programs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line patterns and states written by the external programs.
SUMMARY_PATTERN = r"Delta G binding[^=\n]*=[ \t]*(\S+)"
INFO_PATTERN = r"(?m)^(?=.*GENERAL)(?=.*TOTAL).*?(\S+)[ \t]*$"
TABLE_PATTERN = r"(?m)^(?!.*Attempting)[ \t]*\S*ΔTOTAL\S*[ \t]+(\S+)"
SCORE_PATTERN = r"CNN pose score[^\n]*\n[ \t]*\S+[ \t]+\S+[ \t]+\S+[ \t]+(\S+)"
SUSPICIOUS = "0.00"
SUCCESS = "Success"
STAGES = {
    "Success": "success",
    "Obabel_Failed": "input",
    "PDBQT_Empty": "input",
    "Gnina_Failed": "docking",
    "Failed_Setup": "setup",
    "Failed_Minim": "simulation",
    "Failed_Equil": "simulation",
    "Failed_Production": "simulation",
    "Failed_Analysis": "analysis",
}


def _matches(c: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), F.array().cast("array<string>"))


def _first(c: Column, pattern: str) -> Column:
    return F.slice(_matches(c, pattern), 1, 1)


def _last(c: Column, pattern: str) -> Column:
    return F.slice(_matches(c, pattern), -1, 1)


def _usable(found: Column) -> Column:
    return F.filter(found, lambda x: (x != "") & (x != SUSPICIOUS))


def _number_and_status(found: Column, name: str, failure: str) -> Column:
    """struct(name, status) of the first text in an array.

    Works on one-element arrays so that each pattern is matched once per row however often the
    value is used.
    """
    numbers = F.filter(F.transform(F.slice(found, 1, 1), lambda x: x.try_cast("double")), lambda v: v.isNotNull() & ~F.isnan(v))
    good = F.transform(numbers, lambda v: F.struct(v.alias(name), F.lit(SUCCESS).alias("status")))
    bad = F.array(F.struct(F.lit(None).cast("double").alias(name), F.lit(failure).alias("status")))
    return F.get(F.concat(good, bad), F.lit(0))


def extract_energy(summary: Column, info: Column, log: Column, summary_pattern: str = SUMMARY_PATTERN,
                   info_pattern: str = INFO_PATTERN, table_pattern: str = TABLE_PATTERN) -> Column:
    """struct(delta_g, status) from the summary file, else the info file, else the last total row.

    A suspicious 0.00 falls through to the next source, and is kept only when it is the last answer.
    """
    found = F.concat(_usable(_first(summary, summary_pattern)), _usable(_last(info, info_pattern)), _last(log, table_pattern))
    return _number_and_status(found, "delta_g", "Failed_Analysis")


def extract_score(log: Column, pattern: str = SCORE_PATTERN) -> Column:
    """struct(docking_score, status): fourth field of the line after the last score header.

    One log per candidate: an appended log would hand a failed row its predecessor's score.
    """
    return _number_and_status(_last(log, pattern), "docking_score", "Gnina_Failed")


def status_class(status: Column) -> Column:
    """Which stage a state belongs to; states not in the list are ``unknown``."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for state, stage in STAGES.items():
        out = out.when(status == state, stage)
    return out.otherwise("unknown")
