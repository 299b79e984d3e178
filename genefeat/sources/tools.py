"""Readers of annotation and tool output: text in, typed rows out, by column expressions.

Every reader takes a path, a glob or a list, reads it with spark.read.text, and returns (rows, rejects): lines that look
like data and don't parse are in rejects (path, line) instead of being lost. Malformed numbers become rejects, not
errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .regions import region_files

Paths = str | list[str]


def read_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """(path, line)."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", r"\r$", "").alias("line"))


def _field(i: int, kind: str | None = None) -> Column:
    value = F.try_element_at("f", F.lit(i + 1))
    return value if kind is None else value.try_cast(kind)


def _parsed(lines: DataFrame, fields: dict[str, Column], needed: list[str], where: Column, good: Column | None = None) -> tuple[DataFrame, DataFrame]:
    # One row of the line's fields, as a generator: a filter on them isn't rewritten into one that splits the line for each.
    told = lines.filter(where).select("path", "line", "f", F.inline(F.array(F.struct(*(c.alias(n) for n, c in fields.items())))))
    ok = F.lit(True) if good is None else good
    for n in needed:
        ok = ok & F.col(n).isNotNull()
    flagged = told.withColumn("__ok", F.coalesce(ok, F.lit(False)))
    return flagged.filter("__ok").select("path", *fields), flagged.filter("not __ok").select("path", "line")


def _words(spark: SparkSession, path: Paths) -> DataFrame:
    return read_lines(spark, path).withColumn("f", F.split(F.trim("line"), r"\s+"))


def _tabs(spark: SparkSession, path: Paths) -> DataFrame:
    return read_lines(spark, path).withColumn("f", F.split("line", "\t"))


def attribute_map(text: Column) -> Column:
    """key "value"; pairs as a map; a bare key has the value 1; the last of a repeated key counts."""
    parts = F.filter(F.transform(F.regexp_extract_all(text, F.lit(r'((?:[^;"]|"[^"]*")+)'), F.lit(1)), lambda x: F.trim(x)), lambda x: x != "")
    key = lambda x: F.regexp_extract(x, r"^(\S+)", 1)
    value = lambda x: F.when(x.rlike(r"^\S+\s+\S"), F.regexp_replace(F.regexp_extract(x, r"^\S+\s+(.*)$", 1), r'^"|"$', "")).otherwise("1")
    pairs = F.transform(parts, lambda x: F.struct(key(x).alias("key"), value(x).alias("value")))
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["key"] == x["key"]))
    return F.map_from_entries(last)


FEATURE = ["seq_region", "source", "feature_type", "start", "end", "score", "strand", "phase", "attributes"]


def read_gtf(spark: SparkSession, path: Paths, regions: list[str] | None = None, strand_policy: str = "default_plus", index: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Nine tab-separated columns; comments left out. strand_policy: default_plus takes any other strand for +, fail
    rejects it. regions: lines of these alone, and malformed ones; files that the folder's index (or the one at `index`)
    shows to have none are not opened."""
    if strand_policy not in ("default_plus", "fail"):
        raise ValueError(f"unknown strand policy {strand_policy}")
    files = region_files(spark, path, regions, index) if regions is not None and isinstance(path, str) else [path]
    lines = _tabs(spark, path if files == [path] or not files else files).filter(F.lit(bool(files)))
    strand = F.when(_field(6).isin("+", "-"), _field(6))
    fields = {"seq_region": _field(0), "source": _field(1), "feature_type": _field(2), "start": _field(3, "bigint"), "end": _field(4, "bigint"), "score": _field(5, "double"), "strand": F.coalesce(strand, F.lit("+")) if strand_policy == "default_plus" else strand, "phase": _field(7, "int"), "attributes": attribute_map(_field(8))}
    where = ~F.col("line").startswith("#") & (F.trim("line") != "")
    if regions is not None:
        where = where & (_field(0).isin(*regions) | (F.size("f") != 9))
    return _parsed(lines, fields, ["start", "end", "strand"], where, F.size("f") == 9)


def read_fasta(spark: SparkSession, path: Paths) -> DataFrame:
    """(name, seq): header without >, lines joined; a record at a time, so lines of any number are one row."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", r"^>|\r", "").alias("v")).filter(F.trim("v") != "")
    return raw.select(F.regexp_extract("v", r"^([^\n]*)", 1).alias("name"), F.regexp_replace(F.regexp_replace("v", r"^[^\n]*\n?", ""), r"\s", "").alias("seq"))


def ordered_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """(path, line, n): lines numbered from 0 in their file. A file's pieces are counted, the counts added in order of
    the pieces (a row for each), and each piece numbered on its own."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", r"\r$", "").alias("line"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = raw.groupBy("path", "block").count().select("path", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = raw.withColumn("i", F.row_number().over(Window.partitionBy("path", "block").orderBy("at")))
    return inside.join(starts, ["path", "block"]).select("path", "line", (F.col("i") + F.col("before") - 1).alias("n"))


def read_fastq(spark: SparkSession, path: Paths, mate: int | None = None) -> DataFrame:
    """(sample, mate, read_no from 0 in its file, header, seq, qual): four lines a read; gzip by extension. Sample and
    mate are told by the file's name as in paired_files(), unless a mate is given."""
    lines = ordered_lines(spark, path)
    told = lines.groupBy("path", F.floor(F.col("n") / 4).alias("read_no")).agg(*(F.max(F.when(F.col("n") % 4 == k, F.col("line"))).alias(c) for k, c in ((0, "header"), (1, "seq"), (3, "qual"))))
    sample, number = _sample_and_mate(F.col("path"))
    return told.select(sample.alias("sample"), (number if mate is None else F.lit(mate)).alias("mate"), "read_no", "header", "seq", "qual")


def read_pairs(spark: SparkSession, path: str, mate_path: str | None = None) -> DataFrame:
    one = read_fastq(spark, path, 1)
    return one if mate_path is None else one.unionByName(read_fastq(spark, mate_path, 2))


def read_bed12(spark: SparkSession, path: Paths) -> tuple[DataFrame, DataFrame]:
    numbers = lambda i: F.transform(F.filter(F.split(_field(i), ","), lambda x: x != ""), lambda x: x.try_cast("bigint"))
    fields = {"seq_region": _field(0), "offset": _field(1, "bigint"), "name": _field(3), "strand": _field(5), "sizes": numbers(10), "starts": numbers(11)}
    return _parsed(_tabs(spark, path), fields, ["offset", "name"], F.trim("line") != "", (F.size("f") >= 12) & F.col("strand").isin("+", "-") & (F.size("sizes") == F.size("starts")))


def read_repeatmasker(spark: SparkSession, path: Paths) -> tuple[DataFrame, DataFrame]:
    from ..operators.filters import repeat_class_type

    lines = read_lines(spark, path).withColumn("f", F.split(F.trim(F.regexp_replace("line", r"\s+\*\s*$", "")), r"\s+"))
    plus = _field(8) == "+"
    fields = {"seq_region": _field(4), "start": _field(5, "bigint"), "end": _field(6, "bigint"), "strand": F.when(plus, "+").otherwise("-"), "score": _field(0, "double"), "repeat_name": _field(9), "repeat_class": _field(10), "repeat_type": repeat_class_type(_field(10)), "repeat_start": F.when(plus, _field(11)).otherwise(_field(13)).try_cast("bigint"), "repeat_end": _field(12, "bigint")}
    return _parsed(lines, fields, ["start", "end"], F.col("line").rlike(r"^\s*\d+\s+"), F.size("f") == 15)


def _region(region: str | None) -> Column:
    """The region of a tool's file: given, or from a file name with .rsN.reM, or the file's stem."""
    if region is not None:
        return F.lit(region)
    return F.regexp_extract("path", r"([^/]+?)(?:\.rs\d+\.re\d+)?(?:\.[A-Za-z_]+)*$", 1)


def read_dust(spark: SparkSession, path: Paths, region: str | None = None) -> tuple[DataFrame, DataFrame]:
    at = lambda i: F.regexp_extract("line", r"^\s*(\d+)\s*-\s*(\d+)\s*$", i).try_cast("bigint") + 1
    return _parsed(_words(spark, path), {"seq_region": _region(region), "start": at(1), "end": at(2)}, ["start", "end"], F.col("line").rlike(r"\d"))


def read_trf(spark: SparkSession, path: Paths, region: str | None = None, filtered: bool = True) -> tuple[DataFrame, DataFrame]:
    from ..operators.filters import trf_filter

    fields = {"seq_region": _region(region), "start": _field(0, "bigint"), "end": _field(1, "bigint"), "period": _field(2, "double"), "copies": _field(3, "double"), "matches": _field(5, "double"), "score": _field(7, "double"), "repeat_consensus": _field(13)}
    rows, rejects = _parsed(_words(spark, path), fields, ["start", "end", "period", "copies", "matches", "score"], F.col("line").rlike(r"^\d+"), F.size("f") == 15)
    return (trf_filter(rows) if filtered else rows), rejects


def read_red(spark: SparkSession, path: Paths) -> tuple[DataFrame, DataFrame]:
    got = lambda i: F.regexp_extract("line", r"^>(.+):(\d+)-(\d+)\s*$", i)
    return _parsed(_words(spark, path), {"seq_region": F.nullif(got(1), F.lit("")), "start": got(2).try_cast("bigint") + 1, "end": got(3).try_cast("bigint") + 1}, ["seq_region", "start", "end"], F.trim("line") != "")


def read_eponine(spark: SparkSession, path: Paths) -> tuple[DataFrame, DataFrame]:
    back = F.when(_field(6) == "-", 1).otherwise(0)
    fields = {"seq_region": _field(0), "start": _field(3, "bigint") - back, "end": _field(4, "bigint") - back, "score": _field(5, "double"), "strand": _field(6)}
    return _parsed(_words(spark, path), fields, ["start", "end", "score", "strand"], ~F.col("line").startswith("#") & (F.trim("line") != ""))


def read_cpg(spark: SparkSession, path: Paths, filtered: bool = True) -> tuple[DataFrame, DataFrame]:
    from ..operators.filters import cpg_filter

    fields = {"seq_region": _field(0), "start": _field(1, "bigint"), "end": _field(2, "bigint"), "score": _field(3, "double"), "gc": _field(6, "double"), "oe": F.when(_field(7).isin("-", "inf"), 0.0).otherwise(_field(7, "double"))}
    rows, rejects = _parsed(_words(spark, path), fields, ["start", "end", "score", "gc", "oe"], ~F.col("line").startswith("#") & (F.trim("line") != ""))
    return (cpg_filter(rows) if filtered else rows), rejects


def read_trnascan(spark: SparkSession, path: Paths) -> tuple[DataFrame, DataFrame]:
    """A transcript and an exon for each hit."""
    a, b = _field(2, "bigint"), _field(3, "bigint")
    fields = {"seq_region": _field(0), "start": F.least(a, b), "end": F.greatest(a, b), "strand": F.when(a > b, "-").otherwise("+"), "trna_type": _field(4), "score": _field(8, "double"), "biotype": F.when(F.col("line").contains("high confidence set"), "tRNA").otherwise("tRNA_pseudogene")}
    rows, rejects = _parsed(_words(spark, path), fields, ["start", "end"], ~F.col("line").rlike(r"^(Sequence|Name|-+|#)") & (F.trim("line") != ""), F.size("f") >= 9)
    return rows.withColumn("feature_type", F.explode(F.array(F.lit("transcript"), F.lit("exon")))), rejects


def read_cmsearch_tblout(spark: SparkSession, path: Paths) -> tuple[DataFrame, DataFrame]:
    """Start and end in order, the strand as given."""
    a, b = _field(7, "bigint"), _field(8, "bigint")
    fields = {"seq_region": _field(0), "query": _field(2), "accession": _field(3), "start": F.least(a, b), "end": F.greatest(a, b), "strand": F.when(_field(9) == "+", "+").otherwise("-"), "score": _field(14, "double"), "evalue": _field(15, "double")}
    return _parsed(_words(spark, path), fields, ["start", "end", "score"], ~F.col("line").startswith("#") & (F.trim("line") != ""), F.size("f") >= 16)


def read_genblast_gff(spark: SparkSession, path: Paths) -> tuple[DataFrame, DataFrame]:
    kind = F.when(_field(2) == "coding_exon", "exon").otherwise(_field(2))
    named = F.regexp_extract(_field(8), r"(?:^|;)Name=([^;]+)", 1)
    parent = F.regexp_extract(_field(8), r"Parent=(.+)-R\d+-\d+-", 1)
    fields = {"seq_region": _field(0), "source": _field(1), "feature_type": kind, "start": _field(3, "bigint"), "end": _field(4, "bigint"), "score": _field(5, "double"), "strand": _field(6), "transcript_id": F.nullif(F.when(kind == "exon", parent).otherwise(named), F.lit("")), "exon_number": F.regexp_extract(_field(8), r"-E(\d+);", 1).try_cast("int")}
    rows, rejects = _parsed(_words(spark, path), fields, ["start", "end", "transcript_id"], ~F.col("line").startswith("#") & (F.trim("line") != ""), F.size("f") == 9)
    return rows.withColumn("gene_id", F.col("transcript_id")), rejects


def read_augustus(spark: SparkSession, path: Paths) -> tuple[DataFrame, DataFrame]:
    """Transcript and exon rows of records that an `# end gene` line closes, with ids augN.M by file and record, exons
    numbered in their record, and coordinates moved by the slice that the file's name tells (.rsN.reM.). Rejects are
    such lines without nine columns or numbers, and those of a record that nothing closes.

    A line's record is the number of closers before it: those of its file block are counted within the block, those of
    the blocks before are summed over a row for each block. No file is one task."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", r"\r$", "").alias("line"))
    told = raw.withColumns({"ends": F.col("line").contains("# end gene"), "f": F.split("line", "\t")})
    told = told.withColumn("ours", (_field(1) == "AUGUSTUS") & _field(2).isin("transcript", "exon")).filter("ends or ours")
    blocks = told.groupBy("path", "block").agg(F.count_if("ends").alias("n"))
    so_far = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counted = blocks.select("path", "block", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("path")).alias("closed"))
    inside = F.sum(F.col("ends").cast("bigint")).over(Window.partitionBy("path", "block").orderBy("at"))
    placed = told.withColumn("inside", inside).filter("ours").join(counted, ["path", "block"]).withColumn("record", F.col("inside") + F.col("before"))
    offset = F.coalesce(F.regexp_extract("path", r"\.rs(\d+)\.re\d+\.", 1).try_cast("bigint") - 1, F.lit(0))
    parsed = placed.withColumns({"start": _field(3, "bigint") + offset, "end": _field(4, "bigint") + offset})
    good = (F.size("f") == 9) & (F.col("record") < F.col("closed"))
    flagged = parsed.withColumn("good", F.coalesce(good & F.col("start").isNotNull() & F.col("end").isNotNull(), F.lit(False)))
    files = raw.select("path").distinct().withColumn("file_no", F.dense_rank().over(Window.orderBy("path")))  # a row a file
    number = F.row_number().over(Window.partitionBy("path", "record", "feature_type").orderBy("block", "at"))
    kept = flagged.filter("good").withColumn("feature_type", _field(2)).withColumn("exon_number", number).join(files, "path")
    name = F.concat(F.lit("aug"), F.col("file_no").cast("string"), F.lit("."), (F.col("record") + 1).cast("string"))
    rows = kept.select("path", _field(0).alias("seq_region"), "feature_type", "start", "end", _field(6).alias("strand"), name.alias("gene_id"), name.alias("transcript_id"), F.when(F.col("feature_type") == "exon", F.col("exon_number")).alias("exon_number"))
    return rows, flagged.filter("not good").select("path", "line")


def read_augustus_gff(spark: SparkSession, path: Paths) -> DataFrame:
    """The rows of read_augustus()."""
    return read_augustus(spark, path)[0].drop("path")


def read_star_junctions(spark: SparkSession, path: Paths) -> tuple[DataFrame, DataFrame]:
    fields = {"seq_region": _field(0), "start": _field(1, "bigint"), "end": _field(2, "bigint"), "strand_code": _field(3, "int"), "motif": _field(4, "int"), "uniq": _field(6, "bigint"), "multi": _field(7, "bigint")}
    return _parsed(_tabs(spark, path), fields, list(fields)[1:], F.trim("line") != "", F.size("f") >= 8)


def read_rnasamba(spark: SparkSession, path: Paths) -> tuple[DataFrame, DataFrame]:
    """Of rows that share an id the first one of the first file by name counts."""
    lines = ordered_lines(spark, path).withColumn("f", F.split("line", "\t"))
    fields = {"transcript_id": _field(0), "rnasamba_prob": _field(1, "double"), "rnasamba_coding": _field(2) == "coding", "n": F.col("n")}
    rows, rejects = _parsed(lines, fields, ["rnasamba_prob"], ~F.col("line").startswith("sequence_name") & (F.trim("line") != ""), F.size("f") == 3)
    first = rows.groupBy("transcript_id").agg(F.min_by(F.struct("path", "rnasamba_prob", "rnasamba_coding"), F.struct("path", "n")).alias("x"))
    return first.select("x.path", "transcript_id", "x.rnasamba_prob", "x.rnasamba_coding"), rejects


def read_cpc2(spark: SparkSession, path: Paths) -> tuple[DataFrame, DataFrame]:
    fields = {"transcript_id": _field(0), "length": _field(1, "bigint"), "peptide_length": _field(2, "bigint"), "cpc2_prob": _field(7, "double"), "cpc2_coding": _field(8) == "coding"}
    return _parsed(_tabs(spark, path), fields, ["peptide_length", "cpc2_prob"], ~F.col("line").startswith("#") & (F.trim("line") != ""), F.size("f") == 9)


def read_diamond(spark: SparkSession, path: Paths) -> tuple[DataFrame, DataFrame]:
    return _parsed(_tabs(spark, path), {"transcript_id": _field(0), "evalue": _field(10, "double")}, ["evalue"], F.trim("line") != "", F.size("f") == 12)


def _blocks(spark: SparkSession, path: Paths) -> DataFrame:
    return spark.read.option("lineSep", "//\n").text(path).withColumnRenamed("value", "v")


def _key(pattern: str) -> Column:
    return F.nullif(F.regexp_extract("v", rf"(?m)^{pattern}", 1), F.lit(""))


def read_rfam_seed(spark: SparkSession, path: Paths) -> DataFrame:
    """(accession, name, description, type)."""
    return _blocks(spark, path).select(_key(r"#=GF AC   (.+)$").alias("accession"), _key(r"#=GF ID   (.+)$").alias("name"), _key(r"#=GF DE   (.+)$").alias("description"), _key(r"#=GF TP   Gene; (.+)$").alias("type")).filter("accession is not null")


def read_rfam_cm(spark: SparkSession, path: Paths) -> DataFrame:
    """(name, description, length, max_length, accession, threshold) of INFERNAL models. The threshold has its decimals."""
    told = _blocks(spark, path).filter(F.col("v").contains("INFERNAL"))
    number = lambda p, kind: _key(p).try_cast(kind)
    return told.select(_key(r"NAME\s+(\S+)").alias("name"), _key(r"DESC\s+(\S+)").alias("description"), number(r"CLEN\s+(\d+)", "bigint").alias("length"), number(r"W\s+(\d+)", "bigint").alias("max_length"), _key(r"ACC\s+(\S+)").alias("accession"), number(r"GA\s+(\d+(?:\.\d+)?)", "double").alias("threshold")).filter("name is not null")


def _sample_and_mate(path: Column) -> tuple[Column, Column]:
    pattern = r"([^/]+?)_([12])\.(?:fastq|fq)(?:\.gz)?$"
    hit = path.rlike(pattern)
    alone = F.regexp_extract(path, r"([^/]+?)\.(?:fastq|fq)(?:\.gz)?$", 1)
    return F.when(hit, F.regexp_extract(path, pattern, 1)).otherwise(alone), F.when(hit, F.regexp_extract(path, pattern, 2).cast("int")).otherwise(1)


def paired_files(paths: DataFrame, column: str = "path") -> DataFrame:
    """(path, sample, mate): files name_1.fastq and name_2.fq.gz are mates; another name is a sample of its own."""
    sample, mate = _sample_and_mate(F.col(column))
    return paths.select(F.col(column).alias("path"), sample.alias("sample"), mate.alias("mate"))


def pair_mates(reads: DataFrame) -> DataFrame:
    """(sample, read_no, seq1, seq2, ...): reads (sample, mate, read_no, header, seq, qual) with their mates; null without."""
    side = lambda m: reads.filter(F.col("mate") == m).select("sample", "read_no", *(F.col(c).alias(f"{c}{m}") for c in ("header", "seq", "qual")))
    return side(1).join(side(2), ["sample", "read_no"], "left")
