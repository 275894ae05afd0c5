"""Landed files to DataFrames: price CSV, filing JSON, registry and company profiles.

A reader returns the good rows and a quarantine of (file, reason); one bad file never stops a run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knownby.functions import cleaning as C
from knownby.operators.dedupe import last_row_per_key
from knownby.schemas import COMPANY_FACTS, COMPANY_PROFILE, PRICE_VALUES, PRICES, REGISTRY
from knownby.sources.taxonomy import PENDING_STATUS, SUCCESS_STATUS, sec_tags

_REQUIRED = ["date", *PRICE_VALUES]
_SECURITY_FILE = r"([^/=]*)[.]csv(/|$)"
_END = "\u0003"  # no text of a price file: the control character "end of text"


def packed_files(lines: DataFrame, header: str | None = None, within: Sequence[str] = ()) -> DataFrame:
    """lines(file, line) as one row (file, value) for each file: its lines sorted, below ``header``.

    ``within`` names columns that are the same in all lines of a file; lines dealt out by them do not move again.
    """
    body = F.sort_array(F.collect_list("line"))
    listed = body if header is None else F.concat(F.array(F.lit(header)), body)
    return lines.groupBy(*within, "file").agg(F.array_join(listed, "\n").alias("value")).select("file", "value")


def pack(lines: DataFrame, path: str, header: str | None = None, within: Sequence[str] = (),
         compression: str = "none") -> None:
    """Land many small files packed: lines(file, line) become one JSON record (file, value) for each file.

    A landing of one file per security or company costs a folder entry, a commit and an open each; packs hold
    the same texts under the same names in a few files, which split unless compressed. See ``packed_files``.
    """
    packed_files(lines, header, within).write.option("compression", compression).json(path)


def _whole_files(spark: SparkSession, path: str, pattern: str, packed: bool = False) -> DataFrame:
    """One row per file. Files hold one security's or one company's record, so they stay small.

    ``packed`` reads what ``pack`` wrote; a damaged pack is an error, not a spoilt file.
    """
    if packed:
        packs = spark.read.schema("file string, value string").json(path, mode="FAILFAST")
        return packs.where(F.col("file").like(pattern.replace("*", "%")))
    return (
        spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
        .select(F.col("_metadata.file_path").alias("file"), "value")
    )


def _security_of(file: Column) -> dict[str, Column]:
    """Ids from ``<permaTicker>_<ticker>.csv``, cut at the last underscore.

    The name may be the file's own or that of a folder the file was written into.
    """
    name = F.regexp_extract(file, _SECURITY_FILE, 1)
    symbol = F.when(F.contains(name, F.lit("_")), F.regexp_extract(name, "_([^_]*)$", 1))
    return {
        "permaTicker": F.when(symbol.isNull(), name).otherwise(
            F.regexp_extract(name, "^(.*)_[^_]*$", 1)),
        "ticker": F.coalesce(symbol, F.lit("Unknown")),
    }


def _cells(line: Column, columns: int, pad: Column | None = None) -> Column:
    """The cells of one CSV line as an array of texts, an end mark behind the last.

    A line with a quote is read by Spark's CSV parser, to ``columns`` texts; any other one is cut at its commas.

    The mark shows how many cells the line has: an open quote swallows it, a short or long line moves it.
    ``pad`` commas behind the mark fill a line up to ``columns``: the parser raises an error, slowly, for others.
    """
    schema = ", ".join(f"c{i} string" for i in range(columns))
    ending = [F.lit(f",{_END}")] if pad is None else [F.lit(f",{_END}"), F.repeat(F.lit(","), pad)]
    parsed = F.from_csv(F.concat(line, *ending), schema, {"escape": '"'})
    listed = F.transform(F.array(parsed), lambda row: F.array(*[row[f"c{i}"] for i in range(columns)]))
    quoted = F.get(listed, F.lit(0))  # through a lambda, so that a line is parsed once
    plain = F.split(F.concat(line, F.lit(f",{_END}")), ",")  # the same cells, without the parser's set-up
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(plain)


def _line(text: Column) -> Column:
    """A line without the carriage return before its end."""
    return F.when(F.endswith(text, F.lit("\r")), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)


def read_prices(spark: SparkSession, path: str, max_columns: int = 40,
                packed: bool = False, verdicts: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Price files, loose or ``packed`` (see ``pack``), to (prices, quarantine).

    Columns are found by name in each file's own header, so order may differ and unnamed or extra
    columns are ignored. Cells may be quoted, but not run over line ends; a byte-order mark is skipped.
    Set aside whole, with the first reason that applies: files with more than ``max_columns`` columns,
    without a required column, with a line of more or fewer cells than the header (an open quote too), with a bar
    without a readable date, or with text where a number belongs. Positions are worked out once per
    file. Spoilt files are found by their own pass over the landing, so the good path shuffles
    files at most, none of its rows. ``verdicts`` names a folder to store the spoilt files in first; where they are
    few, they are then sent to the files, which do not move either.
    """
    columns = max_columns + 1
    marked = F.startswith("value", F.lit("\uFEFF"))
    files = (
        _whole_files(spark, path, "*.csv", packed)
        .select("file", F.when(marked, F.expr("substring(value, 2)")).otherwise(F.col("value")).alias("text"))
        .withColumn("_header", F.transform(_cells(_line(F.substring_index("text", "\n", 1)), columns), F.btrim))
        .withColumn("width", (F.array_position("_header", _END) - 1).cast("int"))
        .withColumn("names", F.slice("_header", 1, F.greatest("width", F.lit(0))))
    )
    required = F.array(*[F.lit(c) for c in _REQUIRED])
    complete = (F.col("width") > 0) & (F.col("width") <= max_columns) & (F.size(F.array_except(required, F.col("names"))) == 0)
    headless = files.where(~complete).select("file", F.when(
        (F.col("width") < 0) | (F.col("width") > max_columns), "too many columns or an open quote in the header").otherwise(
        "required column missing").alias("reason"))
    at = F.array(*[(F.array_position("names", c) - 1).cast("int") for c in _REQUIRED])
    whole = files.where(complete).select("file", "width", at.alias("at"), "text")

    def bars_of(some: DataFrame) -> DataFrame:
        """The required cells of every line, and whether it has as many as the header."""
        return (
            some.select("file", "width", "at", F.posexplode(F.split("text", "\n")).alias("_line", "line"))
            .withColumn("line", _line(F.col("line")))
            .where((F.col("_line") > 0) & (F.trim("line") != ""))
            .withColumn("_row", F.get(F.transform(
                F.array(_cells(F.col("line"), columns, F.lit(max_columns) - F.col("width"))),
                lambda row: F.struct((F.array_position(row, _END) == F.col("width") + 1).alias("whole"),
                                     F.transform("at", lambda i: F.btrim(F.get(row, i))).alias("bar"))), F.lit(0)))
            .select("file", F.col("_row.whole").alias("_whole"),
                    *[F.nullif(F.get("_row.bar", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(_REQUIRED)])
        )

    numeric = C.all_of([F.col(c).isNull() | F.col(c).try_cast("double").isNotNull()
                        for c in PRICE_VALUES])
    faults = ["line of another length", "unreadable date", "unreadable number"]
    fault = F.when(~F.col("_whole"), 0).when(C.parse_day(F.col("date")).isNull(), 1).when(~numeric, 2)
    # The verdict of a file is an aggregate without a filter before it, which would parse every line again.
    spoilt = bars_of(whole).groupBy("file").agg(F.min(fault).alias("fault")).where(F.col("fault").isNotNull())
    if verdicts is not None:
        schema = spoilt.schema
        spoilt.write.option("compression", "none").parquet(verdicts)  # plain, as Spark sizes them by their bytes
        spoilt = spark.read.schema(schema).parquet(verdicts)
    prices = (
        bars_of(whole.join(spoilt.select("file"), "file", "left_anti"))  # files move, not their bars
        .select("date", *[F.col(c).try_cast("double").alias(c) for c in PRICE_VALUES],
                *[v.alias(k) for k, v in _security_of(F.col("file")).items()])
        .select(*PRICES.names)
    )
    return prices, headless.unionByName(spoilt.select(
        "file", F.get(F.array(*[F.lit(f) for f in faults]), "fault").alias("reason")))


def with_price_dates(prices: DataFrame) -> DataFrame:
    """Add ``p_date`` from the text date or timestamp of a bar."""
    return prices.withColumn("p_date", C.parse_day(F.col("date")))


def _parsed_json(spark: SparkSession, path: str, schema: T.StructType, packed: bool) -> DataFrame:
    document = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt"})
    return _whole_files(spark, path, "*", packed).select("file", document.alias("d"))


def _split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    broken = F.col("d").isNull() | F.col("d._corrupt").isNotNull()
    bad = parsed.where(broken).select("file", F.lit("unreadable JSON").alias("reason"))
    return parsed.where(~broken), bad


def read_facts(spark: SparkSession, path: str, packed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Company filing documents to (entries, quarantine); entries feed ``operators.facts``.

    Only the us-gaap namespace and the tags of the taxonomy are expanded.
    """
    good, bad = _split_corrupt(_parsed_json(spark, path, COMPANY_FACTS, packed))
    wanted = F.array(*[F.lit(t) for t in sec_tags()])
    entries = (
        good.select(
            C.zfill(F.coalesce("d.cik", F.lit("Unknown")), 10).alias("cik"),
            F.explode(F.map_filter(F.col("d.facts.us-gaap"),
                                   lambda tag, _: F.array_contains(wanted, tag)))
            .alias("sec_tag", "tagged"))
        .select("cik", "sec_tag", F.explode("tagged.units").alias("unit", "reports"))
        .select("cik", "sec_tag", "unit", F.posexplode("reports").alias("pos", "e"))
    )

    def day(field: str) -> Column:
        return F.try_to_date(F.col(f"e.{field}"), "yyyy-M-d")

    return entries.select(
        "cik", "sec_tag", "unit", day("start").alias("start_date"), day("end").alias("end_date"),
        day("filed").alias("filed_date"), F.col("e.fp").alias("fp"), F.col("e.val").alias("val"),
        F.col("pos").cast("bigint").alias("pos"), F.col("e.accn").alias("accession"),
    ), bad


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry CSV by column name, all text; columns the file lacks are null, extra ones are kept."""
    raw = spark.read.csv(path, header=True)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in REGISTRY.fields
               if f.name not in raw.columns}
    wide = raw.withColumns(missing) if missing else raw
    return wide.select(*REGISTRY.names, *[c for c in raw.columns if c not in REGISTRY.names])


def bootstrap_registry(spark: SparkSession, path: str, run_date: str,
                       schema: T.StructType | str | None = None, lines: bool = False) -> DataFrame:
    """Landed vendor metadata plus the tracking columns.

    The vendor delivers one JSON array; ``lines`` reads one record per line, which splits.
    """
    reader = spark.read.option("multiLine", str(not lines).lower())
    landed = (reader.schema(schema) if schema is not None else reader).json(path)
    tracking = ["status_metadata", "status_prices", "status_fundamentals"]
    return landed.withColumns({
        **{c: F.lit(PENDING_STATUS) for c in tracking},
        "last_update": F.lit(None).cast("string"),
        "bootstrap_date": F.lit(run_date),
    })


def read_profiles(spark: SparkSession, path: str, packed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Company profile documents to (profiles(cik, sic, sicDescription), quarantine)."""
    good, bad = _split_corrupt(_parsed_json(spark, path, COMPANY_PROFILE, packed))
    return good.select(C.normalize_cik(F.col("d.cik")).alias("cik"), "d.sic", "d.sicDescription"), bad


def enrich_registry(registry: DataFrame, profiles: DataFrame) -> DataFrame:
    """Fill industry code, sector and industry of listed companies that lack a sector.

    Of several profiles of a company the one with the greatest code and description counts.
    """
    one = last_row_per_key(profiles.select("cik", "sic", "sicDescription"), ["cik"], ["sic", "sicDescription"])
    found = one.select(
        F.col("cik").alias("_cik"), F.col("sic").alias("_sic"),
        F.col("sicDescription").alias("_description"),
        C.classify_sic(F.col("sic"), F.col("sicDescription")).alias("_class"))
    due = F.col("cik").isNotNull() & C.lacks_sector(F.col("sector"))
    key = F.when(due, C.normalize_cik(F.col("cik")))
    hit = F.col("_class").isNotNull()
    new = {"sicCode": F.col("_sic"), "sicIndustry": F.col("_description"),
           "sector": F.col("_class.sector"), "industry": F.col("_class.industry"),
           "status_metadata": F.lit(SUCCESS_STATUS)}
    joined = registry.join(found, key == F.col("_cik"), "left")
    return joined.withColumns({
        c: F.when(hit, v).otherwise(F.col(c)) for c, v in new.items()
    }).select(*registry.columns)
