"""Sequence functions as Column builders; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Complements, and the alphabets of the demonstration mapping of text to bases and qualities.
COMPLEMENT = ("ACGTNacgtn", "TGCANtgcan")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTER_BASES = "ACGTACGTACGTACGTACGTACGTAC"
LETTER_BASES_N = "ACGTACGTACGTACGTACGTACGTNN"
LETTER_QUALITIES = "!#%)+-/13579;=?@ABCDEFGHIJ"
INDEX_FIELD = r"^[ACGTN+_-]+$"
INCOMPARABLE = 999


def normalize_dna(value: Column, allow_n: bool = False) -> Column:
    """Letters only, upper case, U as T; fails the query on an empty result or other letters."""
    dna = F.translate(F.upper(F.regexp_replace(value, "[^A-Za-z]", "")), "U", "T")
    good = dna.rlike("^[ACGTN]+$" if allow_n else "^[ACGT]+$")
    return F.when(good, dna).otherwise(F.raise_error(F.concat(F.lit("not a DNA sequence: "), F.coalesce(value, F.lit("null")))).cast("string"))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, *COMPLEMENT))


def safe_name(value: Column) -> Column:
    cleaned = F.btrim(F.regexp_replace(value, "[^A-Za-z0-9._-]+", "_"), F.lit("._"))
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit("sample"))


def pct(num: Column, den: Column) -> Column:
    """100 * num / den; null where den is 0."""
    return F.try_divide(100.0 * num.cast("double"), den.cast("double"))


def count_of(seq: Column, base: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))


def gc_percent(seq: Column) -> Column:
    return pct(count_of(seq, "G") + count_of(seq, "C"), F.length(seq))


def hamming(a: Column, b: Column) -> Column:
    """Differing positions; sequences of unequal length differ in the longer one's."""
    apart = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, v: s + v)
    return F.when(F.length(a) != F.length(b), F.greatest(F.length(a), F.length(b))).when(a == b, F.lit(0)).otherwise(apart)


def bounded_levenshtein(a: Column, b: Column, limit: int) -> Column:
    """Edit distance, or limit + 1 beyond the limit."""
    d = F.levenshtein(a, b, limit)
    return F.when(d < 0, limit + 1).otherwise(d)


def phred_values(qual: Column) -> Column:
    chars = F.filter(F.split(qual, ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.greatest(F.lit(0), F.ascii(c) - 33))


def phred_sum(qual: Column, least: int | None = None) -> Column:
    """Sum of a string's qualities, or the number of those of at least ``least``."""
    if least is not None:
        return F.length(F.regexp_replace(qual, f"[^{_char_class(least + 33, 126)}]", "")).cast("long")
    return F.aggregate(phred_values(qual), F.lit(0).cast("long"), lambda s, v: s + v)


def _char_class(lo: int, hi: int) -> str:
    return f"\\x{lo:02x}-\\x{hi:02x}"


def header_index(header: Column) -> Column:
    """Sample index of a read header: the last ':' field of its last word, upper case, with '+' between the parts; else null."""
    words = F.split(F.btrim(header), r"\s+")
    field = F.upper(F.element_at(F.split(F.element_at(words, -1), ":"), -1))
    size = F.length(F.replace(field, F.lit("+"), F.lit("")))
    good = (F.size(words) >= 2) & (size >= 6) & (size <= 40) & field.rlike(INDEX_FIELD)
    return F.when(good, F.translate(field, "-_", "++"))


def canonical_read_id(header: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(header, r"\s+"), 1), "/[12]$", "")


def index_distance(observed: Column, expected: Column) -> Column:
    """Differing bases of two indexes whose parts have equal lengths; INCOMPARABLE otherwise."""
    sizes = lambda c: F.transform(F.split(c, "[+]"), F.length)
    return F.when(sizes(observed) == sizes(expected), hamming(observed, expected)).otherwise(INCOMPARABLE)


def log10_count(n: Column) -> Column:
    return F.log10(n + 1.0)


def kmer_windows(seq: Column, k: int, stride: int = 1) -> Column:
    """Windows at 0, stride, 2 * stride, .. and the last one; none for sequences under k.

    The sequence's bytes are bound once, so that a window costs its own length, not its place. One byte a letter.
    """
    last = F.octet_length(seq) - k
    steps = F.sequence(F.lit(0), last, F.lit(stride))
    starts = steps if stride == 1 else F.when(last % stride == 0, steps).otherwise(F.concat(steps, F.array(last)))
    window = lambda raw, p: F.substring(raw, p + 1, F.lit(k)).cast("string")
    cut = F.transform(F.array(seq.cast("binary")), lambda raw: F.transform(starts, lambda p: window(raw, p)))[0]
    return F.when(last >= 0, cut).otherwise(F.array().cast("array<string>"))


def trim_flanks(seq: Column, left_primer: str, right_primer: str, mode: str = "auto") -> Column:
    """A design without its flanks: whole primers first, else their 15 inner bases. ``target`` never trims;
    ``amplicon`` fails on designs without flanks."""
    if mode == "target":
        return seq
    swap = str.maketrans(*COMPLEMENT)
    right = right_primer.translate(swap)[::-1]

    def inner(a: str, b: str) -> tuple[Column, Column]:
        fits = seq.startswith(a) & seq.endswith(b) & (F.length(seq) > len(a) + len(b))
        return fits, F.substring(seq, F.lit(len(a) + 1), F.length(seq) - len(a) - len(b))

    whole, arms = inner(left_primer, right), inner(left_primer[-15:], right[:15])
    rest = seq if mode == "auto" else F.raise_error(F.concat(F.lit("no flanks: "), seq)).cast("string")
    return F.when(whole[0], whole[1]).when(arms[0], arms[1]).otherwise(rest)


def text_dna(text: Column, bases: str = LETTER_BASES) -> Column:
    """Demonstration mapping: the letters of a text as bases."""
    return F.translate(F.upper(F.regexp_replace(text, "[^A-Za-z]", "")), LETTERS, bases)


def text_quality(text: Column) -> Column:
    return F.translate(F.upper(F.regexp_replace(text, "[^A-Za-z]", "")), LETTERS, LETTER_QUALITIES)


# Layout of demultiplexed file names; a name may also be nothing but the read and its chunk.
FILE_NAME = r"(?i)^(?:(.+?)(?:_S\d+)?(?:_L(\d{3}))?[_.](R?[12]|I[12])(?:[_.](\d+))?|[_.]((?-i:[RI][12]))(?:[_.](\d+))?)\.(?:fastq|fq)(?:\.gz)?$"
SHEET_NUMBER = r"_S\d+$"


def file_parts(name: Column) -> Column:
    """sample, lane, read (R1, R2, I1, I2) and chunk of a FASTQ file name, '' for what it lacks; null if it is none."""
    part = lambda i: F.regexp_extract(name, FILE_NAME, i)
    read = F.upper(F.concat(part(3), part(5)))
    fields = F.struct(
        F.regexp_replace(part(1), SHEET_NUMBER, "").alias("sample"), part(2).alias("lane"),
        F.when(F.length(read) == 1, F.concat(F.lit("R"), read)).otherwise(read).alias("read"), F.concat(part(4), part(6)).alias("chunk"),
    )
    return F.when(name.rlike(FILE_NAME), fields)
