"""JSON, TSV and text sources of campaigns: manifests, run records, system lists, job snapshots, logs and exclusions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from atomframe.functions.expressions import task_key

ENTRY = "map<string,string>"
# The fields that may name an entry's target, the first that is not blank wins.
TARGET_FIELDS = ["remote_target", "target", "target_label", "target_server_label", "host_label"]
RECORD = "status string, system_name string, frame_name string, source_structure_path string, sampling struct<start:int,stride:int,count:int>, paths map<string,string>"


def whole_texts(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """file and text, one row for each file."""
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """file, line (from 1) and value of every line."""
    return whole_texts(spark, path, pattern).select("file", F.posexplode(F.split("text", "\r?\n")).alias("line", "value")).withColumn("line", F.col("line") + 1)


def campaign_entries(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (system, frame, target, status, job_id, extras) of campaign documents (file, text): their ``entries``, else
    their ``records``; and the files that are no such document. An item that is no object is left out, the others stay."""
    parsed = texts.withColumn("doc", F.from_json("text", "entries array<string>, records array<string>", {"mode": "PERMISSIVE"}))
    listed = parsed.withColumn("list", F.coalesce("doc.entries", "doc.records"))
    pick = lambda *names: F.coalesce(*[F.nullif(F.trim(F.col("e")[n]), F.lit("")) for n in names])
    core = ["system_name", "frame_name", "remote_target", "status", "job_id", "source_structure_path"]
    items = listed.where("list is not null").select("file", F.explode("list").alias("item")).where(F.ltrim("item").startswith("{"))
    rows = items.select("file", F.from_json("item", ENTRY).alias("e")).where("e is not null")
    fields = {
        "system": pick("system_name", "system"),
        "frame": pick("frame_name", "frame"),
        "target": pick(*TARGET_FIELDS),
        "status": pick("status"),
        "job_id": pick("job_id"),
        "source_structure_path": pick("source_structure_path"),
        "extras": F.map_filter("e", lambda k, v: ~k.isin(*core)),
    }
    entries = rows.select("file", *[c.alias(n) for n, c in fields.items()])
    return entries, listed.where("list is null").select("file")


def read_campaigns(spark: SparkSession, path: str, pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    return campaign_entries(whole_texts(spark, path, pattern))


def read_run_records(spark: SparkSession, root: str) -> DataFrame:
    """frame_info.json files, then those in frame_records (the later place wins); unreadable ones have status null."""
    texts = whole_texts(spark, root, "*.json").where(F.col("file").rlike(r"/system_[^/]*/(frame_[^/]*/frame_info|frame_records/[^/]*)\.json$"))
    broken = {"columnNameOfCorruptRecord": "broken"}
    parsed = texts.select("file", F.from_json("text", f"{RECORD}, broken string", broken).alias("r"), F.col("file").contains("/frame_records/").cast("int").alias("place"))
    system = F.regexp_extract("file", r"/(system_[^/]*)/", 1)
    frame = F.regexp_extract("file", r"/(frame_[^/.]*)(?:/frame_info)?\.json$", 1)
    return parsed.select("file", "place", F.coalesce("r.system_name", system).alias("system"), F.coalesce("r.frame_name", frame).alias("frame"), "r.status", "r.source_structure_path", "r.sampling", "r.paths", (F.col("r").isNull() | F.col("r.broken").isNotNull()).alias("unreadable"))


def system_manifest(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A manifest read as strings (index, system_path, block, label, elements ...): typed rows, and (code, n) of what is
    wrong with it: empty, a bad, repeated or missing index, a missing or repeated path."""
    typed = rows.withColumns({"system_index": F.expr("try_cast(`index` as int)"), "block": F.coalesce(F.nullif(F.trim("block"), F.lit("")), F.lit("unknown")), "label": F.coalesce(F.col("label"), F.lit("")), "elements": F.from_json("elements", "array<string>"), "counts": F.from_json("counts", "array<int>"), "frames": F.expr("try_cast(frames as bigint)"), "natoms": F.expr("try_cast(natoms as int)")})
    n = F.count("*")
    gap = (F.min("system_index") != 0) | (F.max("system_index") != n - 1) | (F.count_distinct("system_index") != n)
    checks = {"empty": n == 0, "index_not_integer": F.count_if(F.col("system_index").isNull()) > 0, "index_not_contiguous": (n > 0) & F.coalesce(gap, F.lit(True)), "path_missing": F.count_if(F.coalesce(F.trim("system_path"), F.lit("")) == "") > 0, "path_repeated": F.count_distinct("system_path") < F.count("system_path")}
    errors = typed.agg(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in checks.items()])).alias("e")).select(F.explode("e").alias("code"))
    return typed, errors


def read_system_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A manifest file, or a folder with one; relative paths in it are below its folder."""
    rows = spark.read.csv(path, sep="\t", header=True)
    below = path.rstrip("/").rpartition("/")[0]
    own = F.trim("system_path")
    absolute = own.rlike("^(/|[A-Za-z][A-Za-z0-9+.-]*:)") | (own == "")
    return system_manifest(rows.withColumn("system_path", F.when(absolute, own).otherwise(F.concat(F.lit(f"{below}/"), F.regexp_replace(own, r"^(\./+)+", "")))))


def job_rows(texts: DataFrame, kind: str) -> DataFrame:
    """Jobs (job_id, name, state, queue, workdir) of saved scheduler outputs (file, text); what a layout lacks is empty.

    ``squeue``: white-space cells id, partition, name, state. ``squeue_pipes``: id|name|state. ``qstat``: cells, the
    first being a number with a host, the fourth and fifth name and state. ``qstat_full`` and ``scontrol``: fields."""
    none = F.lit("")
    if kind in ("squeue", "qstat", "squeue_pipes"):
        row = texts.select("file", F.explode(F.split("text", r"\r?\n")).alias("line")).withColumn("line", F.trim(F.regexp_replace("line", r"\s", " ")))
        row = row.where((F.col("line") != "") & ~F.lower("line").startswith("job") & ~F.col("line").startswith("-"))
        cells = F.split("line", r"\|" if kind == "squeue_pipes" else r"\s+")
        p = [F.trim(F.get(cells, F.lit(i))) for i in range(5)]
        least, columns = {
            "squeue": (4, (p[0], p[2], p[3], p[1])),
            "squeue_pipes": (3, (p[0], p[1], F.upper(p[2]), none)),
            "qstat": (5, (F.regexp_extract(p[0], r"^([^.]*)", 1), p[3], p[4], none)),
        }[kind]
        row = row.where(F.size(cells) >= least)
        row = row.where(p[0].rlike("^[0-9]")) if kind == "qstat" else row
        return row.select("file", *[c.alias(n) for c, n in zip(columns, ("job_id", "name", "state", "queue"), strict=True)], none.alias("workdir"))
    if kind == "scontrol":
        block = texts.select("file", F.explode(F.split("text", r"(?m)(?=^JobId=)")).alias("b")).where("b like 'JobId=%'")
        get = lambda k: F.regexp_extract("b", rf"(?:^|\s){k}=(\S*)", 1)
        return block.select("file", get("JobId").alias("job_id"), get("JobName").alias("name"), F.upper(get("JobState")).alias("state"), get("Partition").alias("queue"), get("WorkDir").alias("workdir")).where("job_id <> ''")
    # a long value goes on in lines that begin with a tab or eight spaces and are no fields themselves
    joined = F.regexp_replace("text", r"[ \t]*\r?\n(?:\t| {8})(?![^\n]* = )[ \t]*", "")
    block = texts.withColumn("text", joined).select("file", F.explode(F.split("text", r"(?m)(?=^Job Id: )")).alias("b")).where("b like 'Job Id: %'")
    get = lambda k: F.trim(F.regexp_extract("b", rf"(?m)^\s*{k} = (.*)$", 1))
    workdir = F.trim(F.regexp_extract("b", r"(?m)^\s*Variable_List = (?:.*,)?PBS_O_WORKDIR=([^,\n]+)", 1))
    return block.select("file", F.trim(F.regexp_extract("b", r"^Job Id:\s*(\S+)", 1)).alias("job_id"), get("Job_Name").alias("name"), F.upper(get("job_state")).alias("state"), get("queue").alias("queue"), workdir.alias("workdir"))


def read_job_snapshots(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return job_rows(whole_texts(spark, path), kind)


def log_metrics(rows: DataFrame, labels: dict[str, str], marker: str, count: str = r"number of test data\s*:\s*([0-9]+)") -> DataFrame:
    """Evaluation logs as lines (file, line, value): test frames and groups counted before the line with ``marker``, and
    each label's number after it (the last one wins); without a marker the numbers are null."""
    where = rows.groupBy(F.col("file").alias("__file")).agg(F.min(F.when(F.col("value").contains(marker), F.col("line"))).alias("__m"))
    joined = rows.join(where, rows["file"].eqNullSafe(where["__file"]))
    n = F.nullif(F.regexp_extract("value", count, 1), F.lit("")).cast("long")
    before = F.coalesce(F.col("line") < F.col("__m"), F.lit(True))
    metrics = []
    for label, name in labels.items():
        value = F.nullif(F.regexp_extract("value", label + r"\s*:\s*([-+0-9.eE]+)", 1), F.lit("")).cast("double")
        metrics.append(F.max_by(value, F.when(value.isNotNull() & (F.col("line") > F.col("__m")), F.col("line"))).alias(name))
    return joined.groupBy("file").agg(F.sum(F.when(before, n)).alias("frames"), F.count(F.when(before, n)).alias("groups"), *metrics)


def with_mev(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({f"{n}_meV": F.col(n) * 1000 for n in names})


def progress(rows: DataFrame, window: int = 600) -> DataFrame:
    """The last line of each log (file, line, value), within its last ``window`` lines, that has total, submitted, running,
    finished and failed; planned is the rest."""
    names = ["total", "submitted", "running", "finished", "failed"]
    get = {n: F.expr(f"try_cast(nullif(regexp_extract(value, '{n}\\\\s*[=:]\\\\s*([0-9]+)', 1), '') as bigint)") for n in names}
    found = rows.select("file", "line", *[c.alias(n) for n, c in get.items()])
    whole = F.col("total").isNotNull() & F.col("finished").isNotNull()
    best = found.groupBy("file").agg(F.max("line").alias("__end"), F.max_by(F.struct("line", *names), F.when(whole, F.col("line"))).alias("p"))
    out = best.where(F.col("p").isNotNull() & (F.col("p.line") > F.col("__end") - window)).select("file", "p.*")
    rest = F.col("total") - sum((F.coalesce(n, F.lit(0)) for n in names[1:]), F.lit(0))
    return out.withColumn("planned", F.greatest(rest, F.lit(0)))


def exclusions(rows: DataFrame) -> DataFrame:
    """Exclusion lines (line, value): kind (task_key, path or unresolved) and key; comments and blank lines are left out."""
    v = F.trim(F.regexp_replace("value", "#.*$", ""))
    clean = rows.withColumn("value", v).where("value <> ''")
    path = F.trim(F.regexp_extract("value", "^path:(.*)$", 1))
    direct = F.trim(F.regexp_replace("value", "^task_key:", ""))
    as_key = F.regexp_extract(direct, r"^(system_[^/_\s]+(?:__|/)frame_[0-9]+)$", 1)
    key: Column = F.when(as_key != "", F.regexp_replace(as_key, "__", "/"))
    kind = F.when(path != "", "path").when(key.isNotNull(), "task_key").when(task_key("value") != "", "task_key").otherwise("unresolved")
    return clean.select("line", "value", kind.alias("kind"), F.when(path != "", path).otherwise(F.coalesce(key, F.nullif(task_key("value"), F.lit("")))).alias("key"))


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    return exclusions(lines(spark, path))


def last_of(rows: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """The last value of each group that is not null."""
    return rows.groupBy(*by).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias(value))

