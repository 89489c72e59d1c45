"""Case folders, file roles and the choice of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocab as V


def hinted_role(c):
    """The first role whose hint a name has: reply, then order, then notice."""
    return F.coalesce(*[F.when(X.col(c).rlike(p), F.lit(r)) for r, p in V.ROLE_HINTS])


def case_keys(folders: DataFrame, folder: str = "folder") -> DataFrame:
    """(folder, case_id): the GSTIN in a folder's name, else the name; later ones of a key get _2, _3, ..."""
    found = F.regexp_extract(folder, V.GSTIN, 1)
    k = folders.select(folder).distinct().withColumn("key", F.when(found != "", found).otherwise(F.col(folder)))
    k = k.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(folder)))
    k = k.withColumn("case_id", F.when(F.col("r") == 1, F.col("key")).otherwise(F.concat_ws("_", "key", F.col("r").cast("string"))))
    # a folder literally named like a numbered key takes the next free number
    again = F.row_number().over(Window.partitionBy("case_id").orderBy("r", folder))
    k = k.withColumn("again", again)
    return k.select(folder, F.when(F.col("again") == 1, F.col("case_id")).otherwise(F.concat("case_id", F.lit("_"), (F.col("again") + 0).cast("string"))).alias("case_id"))


def label(folder):
    """A short label: the GSTIN, else the name made safe, 40 characters."""
    found = F.regexp_extract(folder, V.GSTIN, 1)
    return F.when(found != "", found).otherwise(F.substring(F.regexp_replace(X.col(folder), r"[^\w.-]+", "_"), 1, 40))


def find_case(folders: DataFrame, wanted: str) -> DataFrame:
    """The first folder, in order of name, whose name holds the argument."""
    return folders.where(F.contains(F.lower("folder"), F.lit(wanted.lower()))).orderBy("folder").limit(1)


def role_dirs(dirs: DataFrame) -> DataFrame:
    """(folder, role, dir) of (folder, dir): exact names first, else one loose match for each role still empty."""
    exact = F.coalesce(*[F.when(F.col("dir") == n, F.lit(r)) for r, n in V.ROLE_NAMES.items()])
    d = dirs.select("folder", "dir").distinct().withColumn("exact", exact)
    sure = d.where("exact is not null").select("folder", F.col("exact").alias("role"), "dir")
    loose = d.where("exact is null").withColumn("role", hinted_role("dir")).where("role is not null")
    loose = loose.withColumn("r", F.row_number().over(Window.partitionBy("folder", "role").orderBy("dir"))).where("r = 1").select("folder", "role", "dir")
    return sure.union(loose.join(sure, ["folder", "role"], "left_anti"))


def loose_roles(files: DataFrame) -> DataFrame:
    """(folder, role, dir, file, ...) by hints only: all matching folders, else loose files, notice by default."""
    f = files.withColumn("role", F.when(F.coalesce("dir", F.lit("")) != "", hinted_role("dir")))
    inside = f.where("role is not null")
    rest = f.where("coalesce(dir, '') = ''").join(inside.select("folder").distinct(), "folder", "left_anti")
    return inside.unionByName(rest.withColumn("role", F.coalesce(hinted_role("file"), F.lit("scn"))))


def inventory(files: DataFrame, folders: DataFrame | None = None, kinds: str = r"\.pdf$", others: tuple[str, ...] = ()) -> DataFrame:
    """(case_id, folder, role, dir, file, bytes, pages, size_rank) of (folder, dir, file, bytes, pages).

    folders: all case folders, so that one without any file keeps a row with nulls. kinds: a
    pattern of the names of files that count; others: further columns to keep.
    """
    every = (folders.select("folder") if folders is not None else files.select("folder")).union(files.select("folder")).distinct()
    roles = role_dirs(files)
    kept = files.where(F.col("file").rlike(kinds)).join(roles, ["folder", "dir"])
    rank = F.row_number().over(Window.partitionBy("folder", "role").orderBy(F.col("bytes").desc(), "file"))
    kept = kept.withColumn("size_rank", rank)
    return case_keys(every).join(kept, "folder", "left").select("case_id", "folder", "role", "dir", "file", "bytes", "pages", "size_rank", *others)


def extraction_jobs(inv: DataFrame) -> DataFrame:
    """Files worth reading: every reply, the largest notice and order."""
    return inv.where("role = 'reply' or size_rank = 1")


def scanned_replies(texts: DataFrame) -> DataFrame:
    return texts.where("role = 'reply' and how = 'ocr'")


def pick_replies(texts: DataFrame, key: str = "case_id", pattern: str = V.ARGUES, keep: int = V.MAX_REPLIES) -> DataFrame:
    """The replies worth reading of (key, file, text, size_rank), best first: those that argue most, then the longer."""
    ls = X.lines("text")
    t = texts.where(F.length("text") >= V.MIN_REPLY_CHARS).withColumn("lines", F.slice(ls, 1, V.MAX_REPLY_LINES)).withColumn("truncated", F.greatest(F.size(ls) - V.MAX_REPLY_LINES, F.lit(0)))
    t = t.withColumn("argues", X.argue_score("text", pattern)).withColumn("digits", F.bround(X.digit_ratio("text"), 3)).withColumn("text", F.array_join("lines", "\n"))
    best = Window.partitionBy(key).orderBy(F.col("argues").desc(), F.length("text").desc(), "size_rank")
    return t.withColumn("file_rank", F.row_number().over(best)).where(F.col("file_rank") <= keep)


def choose_text(native, ocr, pages):
    """(text, how): OCR only where the text layer is poor and OCR has more letters."""
    use = X.needs_reread(native, pages) & (X.letters(ocr) > X.letters(native))
    return F.when(use, F.struct(X.col(ocr).alias("text"), F.lit("ocr").alias("how"))).otherwise(F.struct(X.col(native).alias("text"), F.lit("native").alias("how")))
