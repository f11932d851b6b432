"""Reading and writing page documents: JSON pages, recognition results, stage tables, manifests, estimates."""

from __future__ import annotations

import hashlib
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridledger.sources.specs import page_of_path

POINTS_PER_INCH = 72.0
#: Bytes that a page takes in each stage, and the room that a run leaves free.
STAGE_BYTES = {"001.00": 159_000, "002.10": 110_000, "002.11": 112_000, "002.20": 25_000, "002.30": 6_000, "002.40": 100_000, "002.50": 12_000}
HEADROOM_BYTES = 512 * 1024 * 1024


def read_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, one a file, with their page: the document's own, else the file name's; other names are passed over."""
    rows = spark.read.schema(schema).json(path, multiLine=True).withColumn("_p", page_of_path(F.input_file_name()))
    page = F.coalesce(F.col("page").cast("bigint"), F.col("_p")) if "page" in rows.columns else F.col("_p")
    return rows.withColumn("page", page).where(F.col("_p").isNotNull()).drop("_p")


def write_stage(df: DataFrame, path: str) -> None:
    """A stage's table by page; pages in df replace theirs, others stay. The commit is atomic for each run."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("page").parquet(path)


def write_slice(df: DataFrame, path: str) -> None:
    """A stage's table by page; pages that df lacks go."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("page").parquet(path)


def bbox(points: Column) -> Column:
    """struct(x0, y0, x1, y1) around an array of [x, y] points."""
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


LINE = "array<struct<text:string,score:double,points:array<array<double>>,words:array<string>,word_points:array<array<array<double>>>>>"


def payload_lines(payloads: Column, nested: str | None = "res") -> Column:
    """Lines of a page's recognition payloads in order, as recognised_tokens() takes them.

    payloads: array<struct<texts, scores, polygons, words, word_boxes, res>>; a payload without texts of its own stands for
    the payloads in its res, and one without texts or polygons gives nothing.
    """

    def lines(p: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.size(p["texts"]) - 1, F.lit(0)))
        at = lambda c, i: F.get(p[c], i)
        line = lambda i: F.struct(at("texts", i).alias("text"), F.round(at("scores", i), 4).alias("score"), at("polygons", i).alias("points"), at("words", i).alias("words"), at("word_boxes", i).alias("word_points"))
        none = F.array().cast(LINE)
        own = F.when(F.coalesce(F.size(p["texts"]), F.lit(0)) > 0, F.transform(numbers, line).cast(LINE)).otherwise(none)
        own = F.when(p["polygons"].isNull(), none).otherwise(own)
        return F.when(p["texts"].isNull(), F.coalesce(payload_lines(p[nested], None), none)).otherwise(own) if nested else own

    return F.flatten(F.transform(F.filter(payloads, lambda p: p.isNotNull()), lines))


def recognised_tokens(results: DataFrame, dpi: float) -> DataFrame:
    """page, token_id, line_id, text, bbox (points), confidence of recognition results.

    results: page, lines array<struct<text, score, points, words array<string>, word_points>>. A line gives a token for
    each word that isn't blank and has a box; a line without any gives one token. Ids are dense in reading order.
    """
    scale = F.lit(POINTS_PER_INCH / dpi)
    lines = results.select("page", F.posexplode("lines").alias("line_id", "l"))
    boxed = F.least(F.size("l.words"), F.size("l.word_points"))
    words = F.filter(F.slice(F.arrays_zip(F.col("l.words").alias("text"), F.col("l.word_points").alias("points")), F.lit(1), boxed), lambda w: F.trim(w["text"]) != "")
    words = F.transform(words, lambda w: F.struct(F.trim(w["text"]).alias("text"), w["points"].alias("points")))
    found = F.when(F.coalesce(boxed, F.lit(0)) > 0, words)
    whole = F.array(F.struct(F.col("l.text").alias("text"), F.col("l.points").alias("points")))
    tokens = lines.select("page", "line_id", F.round("l.score", 4).alias("confidence"), F.posexplode(F.when(F.coalesce(F.size(found), F.lit(0)) > 0, found).otherwise(whole)).alias("word", "t"))
    box = bbox(F.col("t.points"))
    scaled = F.struct(*[F.round(box[c] * scale, 2).alias(c) for c in ("x0", "y0", "x1", "y1")])
    number = F.row_number().over(Window.partitionBy("page").orderBy("line_id", "word")) - 1
    return tokens.select("page", number.cast("bigint").alias("token_id"), F.col("line_id").cast("bigint").alias("line_id"), F.col("t.text").alias("text"), scaled.alias("bbox"), "confidence")


def merge_pages(old: DataFrame, new: DataFrame) -> DataFrame:
    """The union of two page sets."""
    return old.select("page").union(new.select("page")).distinct()


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of both, of equal keys the new one."""
    return new.unionByName(old.join(new.select(key).distinct(), key, "left_anti"))


def storage_estimate(stages: DataFrame, costs: DataFrame, n_pages: int, fixed: int = 0) -> DataFrame:
    """n_bytes that the stages need for n_pages. stages: stage; costs: stage, bytes_per_page."""
    total = F.coalesce(F.sum("bytes_per_page"), F.lit(0)) * n_pages + fixed
    return stages.join(F.broadcast(costs), "stage").agg(total.cast("bigint").alias("n_bytes"))


def admitted(needed: int, free: int) -> bool:
    """Whether a run may start: its bytes and the headroom fit."""
    return free >= needed + HEADROOM_BYTES


def flag_index(flags: DataFrame) -> DataFrame:
    """page, n_flags of the pages that have any."""
    return flags.groupBy("page").agg(F.count(F.lit(1)).alias("n_flags"))


def stage_summary(pages: DataFrame) -> DataFrame:
    """stage, n_pages, n_fail, n_flags, pass: a stage passes if no page failed. pages: stage, page, ok, n_flags."""
    return pages.groupBy("stage").agg(F.count(F.lit(1)).alias("n_pages"), F.count_if(~F.col("ok")).alias("n_fail"), F.sum("n_flags").alias("n_flags"), F.bool_and("ok").alias("pass"))


def file_digest(path: str) -> str:
    """SHA-256 of a local source document, for a run's manifest."""
    digest = hashlib.sha256()
    with Path(path).open("rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def run_manifest(document: str, pages: list[int], settings: dict, packages: dict[str, str]) -> dict:
    """What a run was made from: the document's digest, its pages, settings and package versions."""
    return {"document": {"name": Path(document).name, "sha256": file_digest(document)}, "pages": sorted(set(pages)), "settings": dict(sorted(settings.items())), "packages": dict(sorted(packages.items()))}


def prune_stale(folder: str, keep: set[str], suffixes: tuple[str, ...] = (".json", ".csv")) -> list[str]:
    """Removes exported files that an export no longer has; refuses a folder that isn't an export's (no index.json)."""
    root = Path(folder)
    if not (root / "index.json").is_file():
        raise ValueError(f"not an export folder: {folder}")
    stale = [p for p in sorted(root.iterdir()) if p.is_file() and p.suffix in suffixes and p.name not in keep | {"index.json"}]
    for p in stale:
        p.unlink()
    return [p.name for p in stale]


def list_runs(folder: str) -> list[str]:
    """Names of the run folders that a viewer can open."""
    return sorted(p.parent.name for p in Path(folder).glob("*/viewer.json"))
