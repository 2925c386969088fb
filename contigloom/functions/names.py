"""Column expressions over file names, headers and table cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contigloom.schemas import FASTA_EXTENSIONS, HIT_FILE_EXTENSIONS

# Fixed value: what a read file may be called; group 1 is the sample, group 2 the mate.
READ_FILE_PATTERN = r"^(.+)[._-]R?([12])(_[0-9]{3})?[.]f(ast)?q([.]gz)?$"

# Fixed value: what a contig file may be called, in any case.
FASTA_FILE_PATTERN = r"(?i)[.](" + "|".join(FASTA_EXTENSIONS) + r")$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path) -> Column:
    return F.substring_index(_col(path), "/", -1)


def stem(path) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(base_name(path), "[.][^.]+$", "")


def sample_from_path(path) -> Column:
    return stem(path)


def sample_from_hit_file(path) -> Column:
    """File name without a sequence-file extension; other extensions stay."""
    listed = "[.](" + "|".join(HIT_FILE_EXTENSIONS) + ")$"
    return F.regexp_replace(base_name(path), listed, "")


def mate_sample(name) -> Column:
    """Sample of a read file; NULL when the name is not one of a read file."""
    return F.nullif(F.regexp_extract(_col(name), READ_FILE_PATTERN, 1), F.lit(""))


def mate_number(name) -> Column:
    return F.nullif(F.regexp_extract(_col(name), READ_FILE_PATTERN, 2), F.lit("")).cast("int")


def contig_id(header) -> Column:
    """First word of the header."""
    return F.split(_col(header), "[ \t]").getItem(0)


# Fixed value: the number that follows a coverage mark in a header.
COVERAGE_NUMBER = "([0-9]+[.]?[0-9]*)"


def _number_after(header, mark: str) -> Column:
    found = F.regexp_extract(_col(header), mark + COVERAGE_NUMBER, 1)
    return F.nullif(found, F.lit("")).try_cast("double")


def coverage_from_header(header) -> Column:
    """Number after ``_cov_``; without one, the number after ``_depth_``; otherwise NULL."""
    return F.coalesce(_number_after(header, "_cov_"), _number_after(header, "_depth_"))


def contig_length(seq) -> Column:
    return F.length(_col(seq))


def na_fill(cell) -> Column:
    """The cell, or ``NA`` if it is empty or NULL; written so that ``cell`` is computed once."""
    return F.coalesce(F.regexp_replace(_col(cell), "^$", "NA"), F.lit("NA"))


def stage_tag(name) -> Column:
    """Stage a file stem shows by its suffix; NULL without one."""
    n = _col(name)
    return (F.when(n.rlike("_before$"), "before")
            .when(n.rlike("_filtered$"), "after")
            .when(n.rlike("_trimmed_R[12]$"), "trimmed")
            .when(n.rlike("_removed$"), "removed"))


def without_stage_tag(name) -> Column:
    return F.regexp_replace(_col(name), "(_before|_filtered|_trimmed_R[12]|_removed)$", "")


def format_duration(seconds) -> Column:
    """``HH:MM:SS``; hours go past 24."""
    s = _col(seconds).cast("long")
    hours = F.floor(s / 3600).cast("long")
    minutes = F.floor((s % 3600) / 60).cast("long")
    return F.format_string("%02d:%02d:%02d", hours, minutes, s % 60)


def timestamp_text(epoch_seconds) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` in the session's time zone."""
    return F.from_unixtime(_col(epoch_seconds), "yyyy-MM-dd HH:mm:ss")


def _version_text(name: Column) -> Column:
    """Text whose byte order is version order, for names without endings.

    Digits become their length and themselves without leading zeros; other characters are marked so that ``~`` comes before
    the end, the end before digits, digits before letters, and letters before everything else.
    """
    runs = F.regexp_extract_all(name, F.lit("([0-9]+|[^0-9]+)"), F.lit(1))

    def encode(run):
        digits = F.regexp_replace(run, "^0+", "")
        sized = F.concat(F.lit("2"), F.lpad(F.length(digits).cast("string"), 9, "0"), digits)
        marked = F.regexp_replace(F.regexp_replace(F.regexp_replace(run, "([^A-Za-z~])", "4$1"), "([A-Za-z])", "3$1"), "~", "0")
        return F.when(run.rlike("^[0-9]"), sized).otherwise(marked)

    none = F.when(name.rlike("[0-9]$"), "").otherwise("2000000000")  # where a number could stand at the end, none is as good as 0
    return F.concat(F.array_join(F.transform(runs, encode), ""), none, F.lit("1"))


def natural_key(name) -> Column:
    """Sort key of version order: s2 before s10, 1.0~rc before 1.0, for runs of digits of any size.

    Names are compared without their endings first (``.tar.gz``: points with a letter or ``~`` after them), then as a whole. Names
    that differ in leading zeros alone have one key, so the name itself has to follow as a key. Names that start with a point come first.
    """
    n = _col(name)
    hidden = F.when(n == "", "0").when(n == ".", "1").when(n == "..", "2").when(n.startswith("."), "3").otherwise("4")
    rest = F.regexp_replace(n, "^[.]", "")
    return F.array(hidden, _version_text(F.regexp_replace(rest, "([.][A-Za-z~][A-Za-z0-9~]*)+$", "")), _version_text(rest))
