"""Nucleotide and protein strings as column expressions."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The standard genetic code, codons in TCAG order; IUPAC letters that stand for several bases.
BASES = "TCAG"
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
AMBIGUOUS = "RYKMSWBDHV"


def upper_ascii(text: Column) -> Column:
    """a-z as A-Z; other letters stay, so none turns into a base."""
    return F.translate(text, ascii_lowercase, ascii_uppercase)


def clean_dna(text: Column, mask_lower: bool = False) -> Column:
    """Upper-case letters only, ambiguous bases as N; with mask_lower, lower-case bases count as N first."""
    text = F.translate(text, "atcg", "NNNN") if mask_lower else text
    return F.translate(F.regexp_replace(upper_ascii(text), "[^A-Z]", ""), AMBIGUOUS, "N" * len(AMBIGUOUS))


def is_dna(text: Column) -> Column:
    return text.rlike("^[ATCGN]*$")


def clean_protein_line(line: Column) -> Column:
    """The first dot of each line goes and every bar becomes an underscore."""
    return F.translate(F.regexp_replace(line, r"(?m)^([^.\n]*)[.]", "$1"), "|", "_")


def reverse_complement(text: Column) -> Column:
    return F.reverse(F.translate(text, "ACGT", "TGCA"))


def codons(text: Column) -> Column:
    """Whole codons from the first base on; none in a text of fewer than three."""
    return F.when(F.length(text) >= 3, F.regexp_extract_all(text, F.lit("(?s)..."), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _place_of_base() -> np.ndarray:
    """By byte: the base's place in BASES, 64 for all else, so that a codon with such a letter lies beyond the code."""
    places = np.full(256, 64, np.int32)
    places[list(BASES.encode())] = range(4)
    return places


def acids(text: bytes) -> bytes:
    """Amino acids of ASCII text, see translate."""
    place = _PLACES[np.frombuffer(text, np.uint8, len(text) - len(text) % 3)]
    codon = np.minimum(place[0::3] * 16 + place[1::3] * 4 + place[2::3], 64)
    found = _ACIDS[codon].tobytes()
    return found[:-1] if found.endswith(b"*") else found


_PLACES, _ACIDS = _place_of_base(), np.frombuffer((AMINO_ACIDS + "X").encode(), np.uint8)


def _translated(texts: pa.Array) -> pa.Array:
    # one letter, one byte: letters that aren't ASCII are in no codon of the code
    return pa.array((None if t is None else acids(t.encode("ascii", "replace")) for t in (x.as_py() for x in texts)), pa.binary()).cast(pa.string())


# not to be computed again by a condition on its result
_translate = F.arrow_udf(_translated, StringType()).asNondeterministic()


def translate(text: Column) -> Column:
    """Amino acids; X for a codon that isn't in the code; one trailing stop is dropped, inner ones stay `*`."""
    return _translate(text)


def spliced(pieces: Column, strand: Column, first_phase: Column, last_phase: Column) -> Column:
    """CDS pieces (left to right) as one coding sequence in frame: the phase of the biologically first piece is trimmed, then what is left of three."""
    joined = F.array_join(pieces, "")
    phase = F.when(strand == "-", last_phase).otherwise(first_phase)
    coding = F.when(strand == "-", reverse_complement(joined)).otherwise(joined)
    cut = F.substring(coding, phase + 1, F.length(coding))
    return F.substring(cut, F.lit(1), F.length(cut) - F.length(cut) % 3)
