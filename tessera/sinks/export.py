"""Views as JSON and as the export's columns, reports of small results, artifacts by content, the inverted index."""

from __future__ import annotations

import gzip
import hashlib
import html
import json
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import money
from ..operators.access import counsel
from ..operators.scoring import size_band
from ..plans.expectations import extension


def view_json(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A line of JSON for each row, nulls included; `</` is escaped, so that a page may embed it."""
    return rows.select(F.replace(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), F.lit("</"), F.lit("<\\/")).alias("value"))


#: Headers of the export, in order.
COLUMNS = (
    "Rank", "Score", "Case", "What happened", "Summary", "Stage", "Court", "Venue", "Jurisdiction", "Plaintiff counsel", "Defendant counsel", "Damages (stated)",
    "Claim size band", "Damages basis", "Thesis", "Event type", "Event date", "Defendants", "Public defendant", "Documents", "Source", "URL",
)


def export(rows: DataFrame) -> DataFrame:
    """rows of the ranked view under the export's headers. A figure stands in its column only if it was stated; a basis tells which it is."""
    stated = ~F.coalesce("damages_imputed", F.lit(True)) & (F.col("damages_usd") > 0)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    values: dict[str, Column] = {
        "Rank": F.col("rank_in_run"), "Score": F.round("score", 4), "Case": text("case_caption"), "What happened": text("description"), "Summary": text("summary"), "Stage": text("stage"),
        "Court": F.coalesce(F.nullif(F.trim(text("court")), F.lit("")), text("venue")), "Venue": text("venue"), "Jurisdiction": text("jurisdiction"),
        "Plaintiff counsel": counsel(F.col("counsel_plaintiff"), F.col("schema_version")), "Defendant counsel": counsel(F.col("counsel_defendant"), F.col("schema_version")),
        "Damages (stated)": F.when(stated, F.col("damages_usd")), "Claim size band": size_band(F.col("damages_usd"), ~stated), "Damages basis": F.when(stated, F.concat(F.lit("stated "), money(F.col("damages_usd")))).otherwise("not stated; inferred for the score"),
        "Thesis": text("deal_thesis"), "Event type": text("event_type"), "Event date": F.coalesce(F.date_format("event_date", "yyyy-MM-dd"), F.lit("")), "Defendants": F.array_join(F.coalesce("defendants", F.array().cast("array<string>")), "; "),
        "Public defendant": F.when(F.col("is_public"), "yes").when(~F.col("is_public"), "no").otherwise("unknown"), "Documents": F.col("cluster_size"), "Source": text("source_id"), "URL": text("source_url"),
    }
    return rows.select(*[values[c].alias(c) for c in COLUMNS])


def write_csv(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").option("header", "true").option("escape", '"').csv(folder)


# --- Artifacts and the index ---------------------------------------------------------------------
#: Bytes from which an artifact is compressed.
COMPRESS_FROM = 2048


def addressed(artifacts: DataFrame) -> DataFrame:
    """artifacts (source_id, url, content_type, content) by content, one row each: sha256, byte_size, ext, compressed, stored."""
    once = artifacts.withColumn("sha256", F.sha2(F.coalesce("content", F.lit(b"")), 256)).dropDuplicates(["sha256"])
    told = once.select("sha256", "source_id", "url", "content_type", F.coalesce(F.octet_length("content"), F.lit(0)).cast("long").alias("byte_size"), extension(F.col("content_type"), F.col("url")).alias("ext"), F.coalesce("content", F.lit(b"")).alias("stored"))
    packed = told.withColumn("compressed", F.col("byte_size") >= COMPRESS_FROM)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(stored=[gzip.compress(bytes(x), mtime=0) if c else bytes(x) for x, c in zip(batch["stored"], batch["compressed"], strict=True)])

    return packed.mapInPandas(pack, packed.schema)


def unpacked(stored: DataFrame) -> DataFrame:
    """Artifacts as they were collected; an error if one isn't what its address says."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            content = [gzip.decompress(bytes(x)) if c else bytes(x) for x, c in zip(batch["stored"], batch["compressed"], strict=True)]
            for sha, body in zip(batch["sha256"], content, strict=True):
                if hashlib.sha256(body).hexdigest() != sha:
                    raise ValueError(f"artifact {sha} is damaged")
            yield pd.DataFrame({"sha256": batch["sha256"], "content": content})

    return stored.select("sha256", "compressed", "stored").mapInPandas(unpack, "sha256 string, content binary")


def postings(items: DataFrame, text: Column) -> DataFrame:
    """token, item_uid and tf of the words of each item's text."""
    words = F.explode(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda x: x != ""))
    return items.select("item_uid", words.alias("token")).groupBy("token", "item_uid").agg(F.count("*").alias("tf"))


def write_index(found: DataFrame, folder: str, buckets: int = 64) -> None:
    """Postings in folders by the token's hash, so that a search reads its tokens' folders only; a bucket's rows may be in many files."""
    found.withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets))).write.mode("overwrite").partitionBy("bucket").parquet(folder)


def search(index: DataFrame, tokens: Sequence[str], buckets: int = 64) -> DataFrame:
    """item_uid and hits of items that hold all the tokens."""
    wanted = sorted({t.lower() for t in tokens})
    if "bucket" in index.columns:
        places = [r[0] for r in index.sparkSession.createDataFrame([(t,) for t in wanted], "t string").select(F.pmod(F.xxhash64("t"), F.lit(buckets))).collect()]
        index = index.where(F.col("bucket").isin(*places))
    return index.where(F.col("token").isin(*wanted)).groupBy("item_uid").agg(F.count("*").alias("n"), F.sum("tf").alias("hits")).where(F.col("n") == len(wanted)).select("item_uid", "hits")


# --- Reports of small results --------------------------------------------------------------------
def run_report(run_id: str, outcomes: Sequence[Mapping], blocked: Sequence[tuple[str, str]] = (), warnings: Sequence[str] = ()) -> str:
    """Markdown of a run: failures first, then partial and blocked sources, warnings and the table of all."""
    bad, part = [o for o in outcomes if o["verdict"] == "BROKEN"], [o for o in outcomes if o["is_partial"]]
    lines = [f"# Run {run_id}", "", f"{sum(o['rows_new'] for o in outcomes)} new, {len(bad)} failed, {len(part)} partial, {len(blocked)} blocked", ""]
    for title, rows in (("Failures", [f"- `{o['source_id']}`: {o['note']}" for o in bad]), ("Partial", [f"- `{o['source_id']}`: {o['note']}" for o in part]), ("Blocked", [f"- `{s}`: {why}" for s, why in blocked]), ("Warnings", [f"- {w}" for w in warnings])):
        if rows:
            lines += [f"## {title}", "", *rows, ""]
    lines += ["| source | verdict | parsed | new |", "|-|-|-|-|", *[f"| {o['source_id']} | {o['verdict']} | {o['rows_parsed']} | {o['rows_new']} |" for o in outcomes]]
    return "\n".join(lines) + "\n"


def digest(rows: DataFrame, warnings: Sequence[str] = (), limit: int = 10) -> tuple[str, str]:
    """Plain text and HTML of the first rows by rank, with what to beware of."""
    top = rows.where("rank_in_run is not null").orderBy("rank_in_run").limit(limit).select("rank_in_run", "case_caption", "description", "score").collect()
    lines = [f"{r['rank_in_run']}. {r['case_caption'] or ''} ({r['score']:.3f}): {r['description'] or ''}" for r in top]
    text = "\n".join([*lines, *(["", "Beware:", *[f"- {w}" for w in warnings]] if warnings else [])]) + "\n"
    items = "".join(f"<li>{html.escape(line.split('. ', 1)[1])}</li>" for line in lines)
    beware = "".join(f"<li>{html.escape(w)}</li>" for w in warnings)
    return text, f"<ol>{items}</ol>" + (f"<ul>{beware}</ul>" if warnings else "")


def dashboard(rows: DataFrame, columns: Sequence[str], counts: Mapping[str, int], warnings: Sequence[str] = (), limit: int = 100) -> str:
    """A page that needs nothing else: the funnel's counts, warnings, and the first rows by rank, embedded as JSON."""
    data = [r[0] for r in view_json(rows.where("rank_in_run is not null").orderBy("rank_in_run").limit(limit), columns).collect()]
    funnel = "".join(f"<li>{html.escape(k)}: {v}</li>" for k, v in counts.items())
    banners = "".join(f"<p class=warning>{html.escape(w)}</p>" for w in warnings)
    script = "const t=document.querySelector('table');for(const r of rows){const x=t.insertRow();for(const c of columns)x.insertCell().textContent=r[c]??''}"
    head = "".join(f"<th>{html.escape(c)}</th>" for c in columns)
    return f"<!doctype html><meta charset=utf-8><title>Matters</title>{banners}<ul>{funnel}</ul><table><tr>{head}</tr></table><script>const columns={json.dumps(list(columns))},rows=[{','.join(data)}];{script}</script>\n"


def publish(spark: object, folder: str, secret: str, files: Mapping[str, str]) -> str:
    """Write small texts and their manifest below a folder that only its name protects; the folder's path."""
    if len(secret) < 16:
        raise ValueError("the secret part of the path needs 16 characters at least")
    if folder.startswith(("http://", "https://", "ftp://")):
        raise ValueError("a public host is no place for a bundle")
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    manifest = {name: {"bytes": len(text.encode()), "sha256": hashlib.sha256(text.encode()).hexdigest()} for name, text in files.items()}
    for name, text in (*files.items(), ("manifest.json", json.dumps(manifest, sort_keys=True))):
        out = store.create(path(f"{folder}/{secret}/{name}"), True)
        out.write(bytearray(text.encode()))
        out.close()
    return f"{folder}/{secret}"
