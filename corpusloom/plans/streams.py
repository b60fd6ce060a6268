"""The streaming twins, run until everything that is there has been read."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions.det import u
from corpusloom.operators import pack, shards
from corpusloom.plans import fixtures as fx
from corpusloom.plans.registry import query, sql_u, table
from corpusloom.plans.runs import STEPS, steps
from corpusloom.plans.tokens import SHOWN, SQL_DOCS, shown, sql_packed
from corpusloom.session import materialize, new_dir
from corpusloom.streaming import streams

TOK = tx.ByteTokenizer()
PARTS = 4
T = 512
GROUPS = 8
SHARDS = 24


def folder(spark, name):
    return new_dir(spark, name)


def arriving(df, path, key, parts=PARTS):
    """Write the rows in ``parts`` steps along the key, one file per step."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    width = (high - low) // parts + 1
    for i in range(parts):
        part = df.filter((F.col(key) >= low + i * width) & (F.col(key) < low + (i + 1) * width))
        part.coalesce(1).write.mode("append").parquet(path)


def documents(spark, sf, name):
    """Numbered shards of the documents, written in parallel; they are read in the order they were finished, whatever their numbers."""
    path = folder(spark, name)
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    rows = materialize(shards.fixed_row_shards(docs, ["doc_id"], -(-docs.count() // SHARDS)), f"{name}-rows")
    last = F.col("doc_id") == F.max("doc_id").over(Window.partitionBy("shard"))
    shards.write_shards(rows.withColumn("last", last).join(docs, "doc_id"), f"{path}/in", ["doc_id"], ["doc_id", "source", "text", "last"])
    stream = streams.stream_shards(spark, f"{path}/in", "doc_id long, source string, text string, last boolean", SHARDS // PARTS)
    return path, streams.with_place(stream)


def byte_ids():
    return F.concat(F.array(F.lit(TOK.special(tx.BOS))), TOK.encode("text"))


def order():
    return streams.ShardOrder(F.col("shard"), F.col("row"), F.col("last"), GROUPS)


# the shards that the documents are written in, and the group of each
SHARDED = f"""{SQL_DOCS}, numbered AS (SELECT key, ids, row_number() OVER (ORDER BY key) - 1 AS i, count(*) OVER () AS n FROM bytes),
  sharded AS (SELECT key, ids, CAST(i // ((n + {SHARDS - 1}) // {SHARDS}) % {GROUPS} AS BIGINT) AS grp FROM numbered)"""


@query("stream_shards", "SELECT doc_id, source, length(text) AS n FROM documents")
def stream_shards(spark, sf):
    path, docs = documents(spark, sf, "stream-shards")
    out = docs.select("doc_id", "source", F.length("text").cast("long").alias("n"))
    streams.run_available(out, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out")


@query("stream_pack", f"WITH RECURSIVE {SHARDED}, {sql_packed('sharded', None, T, 64, 16, 'shortest', finish=False)} SELECT {SHOWN} FROM packed")
def stream_pack(spark, sf):
    path, docs = documents(spark, sf, "stream-pack")
    rows = streams.stream_pack(docs.withColumn("ids", byte_ids()), order(), "ids", None, T, buffer=64, refill=16, doc="doc_id")
    streams.run_available(rows, f"{path}/out", f"{path}/checkpoint")
    return shown(spark.read.schema(pack.PACKED_SCHEMA).parquet(f"{path}/out"))


@query(
    "stream_flat_rows",
    f"""WITH {SHARDED}, g AS (SELECT key, ids, grp AS pack_group FROM sharded),
      o AS (SELECT pack_group, ids, sum(len(ids)) OVER (PARTITION BY pack_group ORDER BY key) - len(ids) AS start,
                   sum(len(ids)) OVER (PARTITION BY pack_group) AS total FROM g),
      s AS (SELECT pack_group, total, CAST(start AS BIGINT) + unnest(range(len(ids))) AS p, unnest(ids) AS id FROM o),
      w AS (SELECT *, p // {T} AS row_id FROM s UNION ALL SELECT *, p // {T} - 1 FROM s WHERE p % {T} = 0 AND p > 0),
      r AS (SELECT pack_group, row_id, list(id ORDER BY p) AS ids, any_value(total) AS total FROM w GROUP BY pack_group, row_id)
    SELECT pack_group, row_id, md5({fx.sql_join(f'ids[:{T}]')}) AS inputs, md5({fx.sql_join('ids[2:]')}) AS targets
    FROM r WHERE row_id < (total - 1) // {T}""",
)
def stream_flat_rows(spark, sf):
    path, docs = documents(spark, sf, "stream-flat")
    rows = streams.stream_flat_rows(docs.withColumn("ids", byte_ids()), order(), "ids", None, T, doc="doc_id")
    streams.run_available(rows, f"{path}/out", f"{path}/checkpoint")
    out = spark.read.schema(streams.FLAT_SCHEMA).parquet(f"{path}/out")
    return out.select("pack_group", "row_id", F.md5(fx.joined("inputs")).alias("inputs"), F.md5(fx.joined("targets")).alias("targets"))


@query(
    "stream_metrics",
    f"""WITH {STEPS}, l AS (SELECT run_id, max(step) AS step FROM numbered GROUP BY run_id)
    SELECT n.run_id, l.step, round(sum(0.1 * n.value * pow(0.9, l.step - n.step)) / (1 - pow(0.9, l.step + 1)), 6) AS smooth_loss,
      round(min(1 + n.value / 1000), 6) AS best, count(*) FILTER ({sql_u('pass', 'n.run_id', 'n.step')} < 0.4) AS n_passed, count(*) AS n_total
    FROM numbered n JOIN l USING (run_id) GROUP BY n.run_id, l.step""",
)
def stream_metrics(spark, sf):
    path = folder(spark, "stream-metrics")
    rows = steps(spark, sf).select("run_id", "step", "loss", "val_bpb", (u("pass", "run_id", "step") < 0.4).alias("passed"))
    arriving(rows, f"{path}/in", "step")
    schema = "run_id long, step long, loss double, val_bpb double, passed boolean"
    metrics = streams.stream_metrics(streams.stream_shards(spark, f"{path}/in", schema))
    streams.run_latest(metrics, f"{path}/out", f"{path}/checkpoint", "run_id")
    out = streams.current(spark, f"{path}/out")
    return out.withColumns({c: F.round(c, 6) for c in ("smooth_loss", "best")})


@query(
    "stream_validate",
    f"""WITH {fx.BAD_TURNS}, c AS (SELECT conv_id, count(*) AS n, CAST(to_json(list({{'role': role, 'content': text}} ORDER BY turn)) AS VARCHAR) AS line,
        bool_or(role <> CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END) AS wrong FROM bad GROUP BY conv_id)
    SELECT md5(line) AS line, CASE WHEN n < 2 OR wrong THEN 'quarantined' ELSE 'accepted' END AS state FROM c""",
)
def stream_validate(spark, sf):
    path = folder(spark, "stream-validate")
    fx.json_lines(fx.bad_turns(spark, sf)).select("value").repartition(PARTS).write.text(f"{path}/in")
    streams.stream_validate(spark, f"{path}/in", f"{path}/accepted", f"{path}/quarantined", f"{path}/checkpoint", 2)
    read = lambda state: spark.read.option("recursiveFileLookup", "true").schema("value string").parquet(f"{path}/{state}").select(
        F.md5("value").alias("line"), F.lit(state).alias("state")
    )
    return read("accepted").unionByName(read("quarantined"))
