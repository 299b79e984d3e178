"""Sequence functions: plain column expressions over nucleotide strings."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import sums_before

# The standard genetic code, codons in the order of the bases TCAG.
BASES = "TCAG"
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = dict(zip(map("".join, product(BASES, repeat=3)), AMINO_ACIDS, strict=True))
STOPS = ("TAA", "TAG", "TGA")
SPLICE_SITES = ("GTAG", "ATAC", "GCAG")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """body(value), with the value worked out once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def reverse_complement(seq: str | Column) -> Column:
    """Case is kept; characters other than ACGT stay as they are."""
    return F.reverse(F.translate(_col(seq), "acgtACGT", "tgcaTGCA"))


def amino_acids(seq: str | Column) -> Column:
    """One letter for each whole codon from the first base on: * for stops, X for codons with other characters."""
    table = F.create_map(*(F.lit(x) for pair in CODONS.items() for x in pair))
    codons = F.regexp_extract_all(F.upper(_col(seq)), F.lit("(?s)(...)"))
    return F.array_join(F.transform(codons, lambda c: F.coalesce(F.try_element_at(table, c), F.lit("X"))), "")


def translate_codons(seq: str | Column) -> Column:
    """amino_acids() of a coding sequence: a length that three does not divide is an error."""
    seq = _col(seq)
    return F.when(F.length(seq) % 3 == 0, amino_acids(seq)).when(seq.isNull(), F.lit(None).cast("string")).otherwise(F.raise_error(F.concat(F.lit("not a multiple of 3: "), F.length(seq).cast("string"))))


# One pattern for all frames: each match begins where the last one ended, so it stays in frame, and the possessive loops
# run over codons without a step of the stack for each. Group 1 is what lies before, group 2 what is looked for.
_STOP = "(?:" + "|".join(STOPS) + ")"
_ORF = rf"(?s)\G((?:(?!ATG)...)*+)(ATG(?:(?!{_STOP})...)*+{_STOP})"
_OPEN = rf"(?s)\G({_STOP}?)((?:(?!{_STOP})...)*+)"


def _in_frame(seq: Column, frame: int, pattern: str) -> Column:
    """array<struct<start, end>> of a pattern's second group, 1-based in seq, ends included."""
    tail = F.upper(F.substring(seq, F.lit(frame + 1), F.length(seq)))
    part = lambda i: F.transform(F.regexp_extract_all(tail, F.lit(pattern), F.lit(i)), lambda x: F.length(x))

    def placed(x: Column) -> Column:
        return F.struct((x["at"] + x["gap"] + frame + 1).alias("start"), (x["at"] + x["gap"] + x["size"] + frame).alias("end"))

    both = F.arrays_zip(part(1).alias("gap"), part(2).alias("size"))
    return let(both, lambda xs: F.transform(F.arrays_zip(sums_before(F.transform(xs, lambda x: x["gap"] + x["size"])).alias("at"), F.transform(xs, lambda x: x["gap"]).alias("gap"), F.transform(xs, lambda x: x["size"]).alias("size")), placed))


def orfs_in_frame(seq: Column, frame: int) -> Column:
    """array<struct<start, end>>: from each stop's first ATG since the last stop to the stop, 1-based in seq."""
    return _in_frame(seq, frame, _ORF)


def open_stretches(seq: Column, frame: int) -> Column:
    """As orfs_in_frame(), of what lies between stops: no need of an ATG, and the last one may run off the end."""
    return F.filter(_in_frame(seq, frame, _OPEN), lambda x: x["end"] >= x["start"])


def best_translation(seq: str | Column, min_aa: int = 50, met_aa: int = 100, factor: int = 2, protein: bool = True) -> Column:
    """struct<start, end, aa, met> (without aa, unless protein) of the translation of a transcript's sequence, or null under min_aa: its longest ORF
    from ATG to stop, or the longest open stretch where that ORF is under met_aa and the stretch is over `factor`
    times as long. Longest, then leftmost."""
    seq = F.upper(_col(seq))
    tell = lambda xs, met: F.transform(xs, lambda x: F.struct((F.floor((x["end"] - x["start"] + 1) / 3) - (1 if met else 0)).alias("n"), (-x["start"]).alias("left"), x["start"].alias("start"), x["end"].alias("end"), F.lit(met).alias("met")))
    with_met = F.array_max(F.concat(*(tell(orfs_in_frame(seq, f), True) for f in range(3))))
    without = F.array_max(F.concat(*(tell(open_stretches(seq, f), False) for f in range(3))))

    def choose(both: Column) -> Column:
        n_met, n_without = F.coalesce(both["met"]["n"], F.lit(0)), F.coalesce(both["open"]["n"], F.lit(0))
        best = F.when((n_met < met_aa) & (n_without > factor * n_met), both["open"]).otherwise(both["met"])
        aa = [amino_acids(F.substring(seq, best["start"].cast("int"), (best["n"] * 3).cast("int"))).alias("aa")] if protein else []
        return F.when(best["n"] >= min_aa, F.struct(best["start"].alias("start"), best["end"].alias("end"), *aa, best["met"].alias("met")))

    return let(F.struct(with_met.alias("met"), without.alias("open")), choose)


def is_canonical_splice(intron: str | Column) -> Column:
    intron = F.upper(_col(intron))
    return F.concat(F.substring(intron, 1, 2), F.right(intron, F.lit(2))).isin(*SPLICE_SITES)


def valid_cds(seq: str | Column, min_length: int | Column) -> Column:
    seq = F.upper(_col(seq))
    return seq.rlike("^ATG") & seq.rlike("(TAA|TAG|TGA)$") & (F.length(seq) >= min_length)


def pas_cut_site(seq: str | Column, coding_offset: int | Column, max_utr: int = 1000) -> Column:
    """Length to which an exon's sequence is cut, or null for no cut. The first AATAAA past the coding offset ends at p:
    cut after the A of the first CA in p+15 to p+29, else at p+30. Without a signal, at coding offset + max_utr."""
    offset = F.lit(coding_offset) if isinstance(coding_offset, int) else coding_offset

    def from_end(x: Column) -> Column:
        near = F.instr(F.substring(x["seq"], x["end"] + 15, F.lit(15)), "CA")
        return let(F.struct(x["seq"].alias("seq"), F.when(x["signal"] > 0, F.when(near > 0, x["end"] + 15 + near).otherwise(x["end"] + 30)).when(F.length(x["seq"]) - x["offset"] > max_utr, x["offset"] + max_utr).alias("cut")), lambda y: F.when(y["cut"] < F.length(y["seq"]), y["cut"]))

    def found(x: Column) -> Column:
        signal = F.instr(F.substring(x["seq"], x["offset"] + 1, F.length(x["seq"])), "AATAAA")
        return let(signal, lambda g: let(F.struct(x["seq"].alias("seq"), x["offset"].alias("offset"), g.alias("signal"), (x["offset"] + g + 5).alias("end")), from_end))

    return let(F.struct(F.upper(_col(seq)).alias("seq"), offset.alias("offset")), found)


def exon_string(exons: str | Column, strand: str | Column) -> Column:
    """start:end:strand of each exon in transcript order."""
    strand = _col(strand)
    told = F.transform(_col(exons), lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"), F.when(strand == "-", "-1").otherwise("1")))
    return F.array_join(F.when(strand == "-", F.reverse(told)).otherwise(told), ":")


def introns(exons: str | Column) -> Column:
    """array<struct<start, end>> of the gaps between consecutive exons, ascending."""
    exons = _col(exons)
    n = F.greatest(F.size(exons) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(exons, 1, n).alias("a"), F.slice(exons, 2, n).alias("b"))
    return F.transform(pairs, lambda p: F.struct((p["a"]["end"] + 1).alias("start"), (p["b"]["start"] - 1).alias("end")))


def intron_string(exons: str | Column) -> Column:
    return F.array_join(F.transform(introns(exons), lambda x: F.concat(x["start"].cast("string"), F.lit(".."), x["end"].cast("string"), F.lit(":"))), "")
