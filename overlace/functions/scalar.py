"""Scalar functions on sequences, intervals, overlaps and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Overlap flag bits and their letters (fixed values).
FLAGS = {
    "comp": (0, "C"), "discard": (1, "D"), "repeat": (3, "R"), "local": (4, "L"), "diff": (5, "I"), "stitch": (7, "S"), "symdiscard": (8, "Y"), "olen": (9, "O"),
    "rlen": (10, "E"), "temp": (11, "T"), "cont": (15, "N"), "gap": (16, "G"), "trim": (17, "M"), "module": (18, "U"), "optional": (19, "P"),
}


def bit(name: str) -> int:
    return 1 << FLAGS[name][0]


def has(flags: Column, name: str) -> Column:
    return flags.bitwiseAND(F.lit(bit(name))) != 0


def with_flag(flags: Column, name: str, when: Column) -> Column:
    """``flags`` with the bit set, and discarded, where ``when`` holds."""
    return F.when(F.coalesce(when, F.lit(False)), flags.bitwiseOR(F.lit(bit(name) | bit("discard")))).otherwise(flags)


def flags_to_text(flags: Column) -> Column:
    return F.concat_ws("", *(F.when(has(flags, name), F.lit(letter)) for name, (_, letter) in FLAGS.items()))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "acgtACGT", "tgcaTGCA"))


def wrapped(seq: Column, width: int = 80) -> Column:
    return F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")


def parse_bp(text: Column) -> Column:
    """Bases in ``3g``, ``4m``, ``5k`` or ``6``; null for other texts."""
    number = F.regexp_extract(text, r"^([0-9]+(?:\.[0-9]+)?)([gmkGMK]?)$", 1)
    unit = F.lower(F.regexp_extract(text, r"^([0-9]+(?:\.[0-9]+)?)([gmkGMK]?)$", 2))
    factor = F.when(unit == "g", 1_000_000_000).when(unit == "m", 1_000_000).when(unit == "k", 1_000).otherwise(1)
    return F.when(number != "", F.floor(number.cast("double") * factor).cast("long"))


def format_bp(bases: Column) -> Column:
    cut = lambda unit, letter: F.concat(F.floor(bases / unit).cast("string"), F.lit(letter))
    return F.when(bases >= 1_000_000_000, cut(1_000_000_000, "g")).when(bases >= 1_000_000, cut(1_000_000, "m")).when(bases >= 1_000, cut(1_000, "k")).otherwise(bases.cast("string"))


def intersection(beg_a: Column, end_a: Column, beg_b: Column, end_b: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end_a, end_b) - F.greatest(beg_a, beg_b))


def contained(beg: Column, end: Column, in_beg: Column, in_end: Column) -> Column:
    return (beg >= in_beg) & (end <= in_end)


def identity(diffs: Column, length: Column) -> Column:
    return 100.0 - 100.0 * diffs / length


def divergence(diffs: Column, len_a: Column, len_b: Column) -> Column:
    return F.floor(100.0 * 2 * diffs / (len_a + len_b)).cast("long")


def floor_div(a: Column, b) -> Column:
    return F.floor(a / b).cast("long")


def kmer_code(kmer: Column) -> Column:
    """2 bits a base, as a number."""
    return F.conv(F.translate(kmer, "acgt", "0123"), 4, 10).cast("long")


def gaussian_density(x: Column, mean: Column, sd: Column) -> Column:
    return F.exp(-((x - mean) * (x - mean)) / (2 * sd * sd)) / (sd * F.sqrt(2 * F.pi()))
