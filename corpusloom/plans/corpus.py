"""Scanning, sharding, filtering, budgets and mixing over ``documents``.

``source`` stands for the shard name, English documents for the first corpus, all others for the second.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import mix, shards
from corpusloom.operators.prefix import budget_cutoff, up_to
from corpusloom.plans.fixtures import WORDS, words
from corpusloom.plans.registry import query, sql_u, table
from corpusloom.session import materialize, new_dir
from corpusloom.sources import scan

documents = partial(table, name="documents")


def pair(spark, sf):
    docs = documents(spark, sf)
    return docs.filter(F.col("lang") == "en"), docs.filter(F.col("lang") != "en")


# --- scans and sinks -------------------------------------------------------------------------------


@query(
    "shard_inventory",
    """SELECT source AS shard, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars
       FROM documents GROUP BY source""",
)
def shard_inventory(spark, sf):
    return scan.shard_inventory(documents(spark, sf), "source")


@query(
    "split_train_val",
    """SELECT doc_id, source, CASE WHEN source = (SELECT max(source) FROM documents) THEN 'val' ELSE 'train' END AS split
       FROM documents""",
)
def split_train_val(spark, sf):
    docs = documents(spark, sf).select("doc_id", "source")
    train = scan.split_train_val(docs, "train", "source").withColumn("split", F.lit("train"))
    return train.unionByName(scan.split_train_val(docs, "val", "source").withColumn("split", F.lit("val")))


@query(
    "rank_stride",
    """SELECT doc_id, source, (rn - 1) // 16 AS row_group, ((rn - 1) // 16) % 3 AS worker
       FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents)""",
)
def rank_stride(spark, sf):
    out = scan.rank_stride(documents(spark, sf), 3, 16, "source", "doc_id")
    return out.select("doc_id", "source", "row_group", "worker")


@query(
    "fixed_row_shards",
    """SELECT shard, count(*) AS n_docs, min(doc_id) AS first_id, max(doc_id) AS last_id
       FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS shard FROM documents) GROUP BY shard""",
)
def fixed_row_shards(spark, sf):
    rows = shards.fixed_row_shards(documents(spark, sf), ["doc_id"], 64)
    return rows.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )


WALK = """
  walk AS (
    SELECT CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS shard, CAST(0 AS BIGINT) AS chars, false AS closed
    UNION ALL
    SELECT d.rn, CASE WHEN w.closed THEN w.shard + 1 ELSE w.shard END,
           CASE WHEN w.closed THEN 0 ELSE w.chars END + d.n,
           CASE WHEN w.closed THEN 0 ELSE w.chars END + d.n >= {budget} AND d.rn % {align} = 0
    FROM walk w JOIN d ON d.rn = w.rn + 1)"""


BUDGET_WALK = f"""WITH RECURSIVE
      d AS (SELECT doc_id, length(text) AS n, row_number() OVER (ORDER BY {sql_u(42, 'doc_id')}, doc_id) AS rn
            FROM documents),
      {WALK.format(budget=200_000, align=16)}"""


@query("budget_shards", f"{BUDGET_WALK} SELECT d.doc_id, w.shard FROM walk w JOIN d ON d.rn = w.rn WHERE w.shard IN (SELECT shard FROM walk WHERE closed)")
def budget_shards(spark, sf):
    return budgeted(spark, sf).select("doc_id", "shard")


def budgeted(spark, sf):
    docs = mix.seeded_order(documents(spark, sf), 42, "doc_id")
    return shards.greedy_shards(docs, ["u", "doc_id"], F.length("text"), 200_000, align=16, flush_tail=False)


# the number of a shard and of a row in it, as the files tell them
FILED = "printf('shard_%05d.parquet', shard) AS shard, row_number() OVER (PARTITION BY shard ORDER BY {order}) - 1 AS row_index, doc_id, n AS n_chars"


def filed(spark, sf, rows, order):
    """Write the documents of numbered shards, half of the shards in a first run that the second one goes on from, and read them again."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = materialize(rows.select(*dict.fromkeys(["doc_id", *order]), "shard"), "shard-rows").join(docs, "doc_id")
    path = new_dir(spark, "shards")
    shards.write_shards(rows.filter("shard % 2 = 0"), path, order, ["doc_id", "text"])
    shards.write_shards(rows, path, order, ["doc_id", "text"])
    back = scan.read_shards(spark, path, "doc_id long, text string")
    return back.select("shard", "row_index", "doc_id", F.length("text").cast("long").alias("n_chars"))


@query(
    "row_shard_files",
    f"""SELECT {FILED.format(order='doc_id')}
        FROM (SELECT doc_id, length(text) AS n, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS shard FROM documents)""",
)
def row_shard_files(spark, sf):
    return filed(spark, sf, shards.fixed_row_shards(documents(spark, sf), ["doc_id"], 64), ["doc_id"])


@query(
    "budget_shard_files",
    f"""{BUDGET_WALK}, s AS (SELECT d.doc_id, d.n, d.rn, w.shard FROM walk w JOIN d ON d.rn = w.rn WHERE w.shard IN (SELECT shard FROM walk WHERE closed))
    SELECT {FILED.format(order='rn')} FROM s""",
)
def budget_shard_files(spark, sf):
    return filed(spark, sf, budgeted(spark, sf), ["u", "doc_id"])


CHAR_WALK = f"""WITH RECURSIVE
      t AS (SELECT doc_id, length(text) AS n, source = (SELECT max(source) FROM documents) AS val FROM documents),
      d AS (SELECT doc_id, n, row_number() OVER (ORDER BY doc_id) AS rn FROM t WHERE NOT val),
      {WALK.format(budget=150_000, align=1)},
      s AS (SELECT d.doc_id, d.n, w.shard FROM walk w JOIN d ON d.rn = w.rn
            UNION ALL
            SELECT doc_id, n, (SELECT max(shard) + 1 FROM walk) FROM t WHERE val)"""


@query("char_shards", f"{CHAR_WALK} SELECT shard, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_chars, min(doc_id) AS first_id FROM s GROUP BY shard")
def char_shards(spark, sf):
    return char_sharded(spark, sf).groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("n_chars"), F.min("doc_id").alias("first_id")
    )


def char_sharded(spark, sf):
    """The shards of the training part, and the validation part as one more."""
    docs = documents(spark, sf)
    rows = shards.greedy_shards(scan.split_train_val(docs, "train", "source"), ["doc_id"], F.length("text"), 150_000)
    last = rows.agg(F.max("shard")).first()[0]
    val = scan.split_train_val(docs, "val", "source").select(
        "doc_id", F.length("text").cast("long").alias("size"), F.lit(last + 1).cast("long").alias("shard")
    )
    return rows.unionByName(val)


@query("char_shard_files", f"{CHAR_WALK} SELECT {FILED.format(order='doc_id')} FROM s")
def char_shard_files(spark, sf):
    return filed(spark, sf, char_sharded(spark, sf), ["doc_id"])


@query("guarded_overwrite", "SELECT doc_id, source, n_chars FROM documents")
def guarded_overwrite(spark, sf):
    path = new_dir(spark, "guarded-overwrite")
    scan.guarded_overwrite(documents(spark, sf).select("doc_id", "source", "n_chars"), path, overwrite=True)
    return spark.read.parquet(path)


@query(
    "missing_shards",
    """SELECT i AS shard_id FROM range(1823) t(i)
       WHERE i NOT IN (SELECT DISTINCT CAST(substr(source, 4) AS BIGINT) FROM documents)""",
)
def missing_shards(spark, sf):
    present = documents(spark, sf).select(F.substring("source", 4, 9).alias("shard_id"))
    return scan.missing_shards(spark, present)


# --- filters and projections -----------------------------------------------------------------------


@query("nonempty_docs", "SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND text <> ''")
def nonempty_docs(spark, sf):
    return documents(spark, sf).filter(mix.nonempty()).select("doc_id", "text")


@query("doc_cap", "SELECT doc_id, substr(text, 1, 10000) AS text FROM documents")
def doc_cap(spark, sf):
    return documents(spark, sf).select("doc_id", mix.doc_cap().alias("text"))


@query("min_length_docs", "SELECT doc_id, n_chars FROM documents WHERE length(text) >= 100")
def min_length_docs(spark, sf):
    return documents(spark, sf).filter(F.length("text") >= 100).select("doc_id", "n_chars")


@query("pick_text_column", "SELECT c_custkey AS id, c_name AS text FROM customer")
def pick_text_column(spark, sf):
    return scan.pick_text_column(table(spark, sf, "customer")).select(F.col("c_custkey").alias("id"), "text")


@query("script_filter", "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[À-ÿ]')")
def script_filter(spark, sf):
    return documents(spark, sf).filter(mix.script_filter("text", "À", "ÿ")).select("doc_id", "lang")


@query(
    "task_slice",
    """SELECT (i - 5) // 3 AS idx, doc_id
       FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) WHERE i >= 5 AND (i - 5) % 3 = 0""",
)
def task_slice(spark, sf):
    return mix.task_slice(mix.index_rows(documents(spark, sf), "doc_id"), "idx", start=5, step=3)


# --- sorts and limits ------------------------------------------------------------------------------


@query(
    "seeded_shuffle",
    f"SELECT doc_id, row_number() OVER (ORDER BY {sql_u(42, 'doc_id')}, doc_id) - 1 AS pos FROM documents",
)
def seeded_shuffle(spark, sf):
    return mix.seeded_shuffle(documents(spark, sf), 42, "doc_id")


@query(
    "head_per_task",
    f"""SELECT source, doc_id FROM documents
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY {sql_u(1337, 'doc_id')}, doc_id) <= 7""",
)
def head_per_task(spark, sf):
    return mix.head_per_task(documents(spark, sf).select("source", "doc_id"), "source", 1337, 7, "doc_id")


# --- set operations and joins of two corpora -------------------------------------------------------

TASKS = """
  idx AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i FROM documents),
  tasks AS (SELECT 0 AS task_pos, i AS local_idx, doc_id FROM idx WHERE lang = 'en'
            UNION ALL SELECT 1, i // 2, doc_id FROM idx WHERE lang = 'fr' AND i % 2 = 0
            UNION ALL SELECT 3, i, doc_id FROM idx WHERE lang = 'de'
            UNION ALL SELECT 4, i, doc_id FROM idx WHERE lang = 'de')"""


def listed_tasks(spark, sf):
    docs = documents(spark, sf)
    lang = lambda x: mix.index_rows(docs.filter(F.col("lang") == x), "doc_id")
    german = lang("de")
    return [lang("en"), mix.task_slice(lang("fr"), "idx", step=2), None, german, german]


@query(
    "task_mixture",
    f"""WITH {TASKS}
    SELECT row_number() OVER (ORDER BY {sql_u(42, 'task_pos', 'local_idx')}, task_pos, local_idx) - 1 AS pos,
           task_pos, local_idx, doc_id FROM tasks""",
)
def task_mixture(spark, sf):
    return mix.task_mixture(listed_tasks(spark, sf)).select("pos", "task_pos", "local_idx", "doc_id")


@query(
    "task_sequence",
    f"""WITH {TASKS}
    SELECT row_number() OVER (ORDER BY task_pos, local_idx) - 1 AS pos, task_pos, doc_id FROM tasks""",
)
def task_sequence(spark, sf):
    return mix.task_sequence(listed_tasks(spark, sf)).select("pos", "task_pos", "doc_id")


SLOTS = f"""
  numbered AS (SELECT doc_id, text, lang = 'en' AS is_first,
                      row_number() OVER (PARTITION BY lang = 'en' ORDER BY doc_id) AS k FROM {{docs}}),
  n AS (SELECT count(*) FILTER (is_first) AS n1, count(*) FILTER (NOT is_first) AS n2 FROM numbered),
  draws AS (SELECT s AS slot, {sql_u(42, 's')} < 0.7 AS is_first
            FROM range(1, (SELECT n1 + n2 + 1 FROM n)) t(s)),
  filled AS (SELECT slot, is_first, row_number() OVER (PARTITION BY is_first ORDER BY slot) AS k,
                    sum(CASE WHEN is_first THEN 1 ELSE 0 END) OVER (ORDER BY slot) AS f FROM draws),
  stop AS (SELECT min(slot) AS last FROM filled, n WHERE f = n1 OR slot - f = n2),
  slots AS (SELECT slot, is_first, k FROM filled WHERE slot <= (SELECT last FROM stop)),
  mixed AS (SELECT m.doc_id, m.text, m.is_first,
                   coalesce(s.slot, m.k + CASE WHEN m.is_first THEN n2 ELSE n1 END) AS pos
            FROM numbered m CROSS JOIN n LEFT JOIN slots s ON s.is_first = m.is_first AND s.k = m.k)"""


@query("ratio_mix", f"WITH {SLOTS.format(docs='documents')} SELECT doc_id, is_first, pos FROM mixed")
def ratio_mix(spark, sf):
    return mix.ratio_mix(*pair(spark, sf), "doc_id", 0.7)


@query(
    "ratio_merge",
    f"""WITH {SLOTS.format(docs='documents')}
    SELECT m.doc_id, m.is_first, m.k, s.slot FROM numbered m JOIN slots s ON s.is_first = m.is_first AND s.k = m.k""",
)
def ratio_merge(spark, sf):
    return mix.ratio_merge(*pair(spark, sf), "doc_id", 0.7)


def inserted(first, seed=42, p=0.3 / 0.7):
    return f"""
  f AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS g, {sql_u(seed, 'doc_id')} < {p!r} AS flag FROM {first}),
  fc AS (SELECT doc_id, g, flag, sum(CASE WHEN flag THEN 1 ELSE 0 END) OVER (ORDER BY g) AS c FROM f),
  s AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents WHERE lang <> 'en'),
  mixed AS (SELECT doc_id, true AS is_first, g AS "group", CAST(g + c - CASE WHEN flag THEN 1 ELSE 0 END AS BIGINT) AS pos FROM fc
            UNION ALL
            SELECT s.doc_id, false, g, CAST(g + c AS BIGINT) FROM fc
            JOIN s ON flag AND s.k = (c - 1) % (SELECT count(*) FROM s))"""


@query(
    "insert_mix",
    f"""WITH en AS (SELECT * FROM documents WHERE lang = 'en'), {inserted('en')}
    SELECT doc_id, is_first, "group", pos FROM mixed""",
)
def insert_mix(spark, sf):
    return mix.insert_mix(*pair(spark, sf), "doc_id", 0.3)


MIX_SHARD_CHARS = 60_000


@query(
    "mixed_shards",
    f"""WITH RECURSIVE en AS (SELECT * FROM documents WHERE lang = 'en'), {inserted('en')},
      sized AS (SELECT m.*, length(t.text) AS n FROM mixed m JOIN documents t USING (doc_id)),
      d AS (SELECT "group" AS rn, sum(n) AS n FROM sized GROUP BY "group"),
      {WALK.format(budget=MIX_SHARD_CHARS, align=1)}
    SELECT printf('shard_%05d.parquet', w.shard) AS shard, row_number() OVER (PARTITION BY w.shard ORDER BY s.pos) - 1 AS row_index, s.doc_id, s.n AS n_chars
    FROM sized s JOIN walk w ON w.rn = s."group" """,
)
def mixed_shards(spark, sf):
    """Mix, shard, write, and read again."""
    first, second = pair(spark, sf)
    mixed = mix.insert_mix(first, second, "doc_id", 0.3)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = shards.mixed_shards(mixed, docs.select("doc_id", F.length("text").alias("size")), "doc_id", MIX_SHARD_CHARS)
    return filed(spark, sf, rows.select("doc_id", "pos", "shard"), ["pos"])


@query(
    "cycle_join",
    """WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS j FROM documents WHERE lang = 'en'),
      b AS (SELECT doc_id AS second_id, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents WHERE lang <> 'en')
    SELECT a.doc_id, b.second_id FROM a JOIN b ON b.k = a.j % (SELECT count(*) FROM b)""",
)
def cycle_join(spark, sf):
    first, second = pair(spark, sf)
    pool = mix.index_rows(second, "doc_id", "pool_idx").withColumnRenamed("doc_id", "second_id")
    out = mix.cycle_join(mix.index_rows(first, "doc_id", "j"), pool, "j", second.count())
    return out.select("doc_id", "second_id")


@query(
    "draw_from_pool",
    f"""WITH {WORDS}
    SELECT d.doc_id, w.word FROM documents d CROSS JOIN n_words n
    JOIN words w ON w.idx = CAST(floor({sql_u('pool', 'd.doc_id')} * n.n) AS BIGINT)""",
)
def draw_from_pool(spark, sf):
    pool, n = words(spark, sf)
    out = mix.draw_from_pool(documents(spark, sf).select("doc_id"), pool, n, "pool", "doc_id")
    return out.select("doc_id", "word")


@query("first_available", "SELECT doc_id, lang FROM documents WHERE lang = 'es'")
def first_available(spark, sf):
    docs = documents(spark, sf).select("doc_id", "lang")
    return mix.first_available([docs.filter(F.col("lang") == x) for x in ("ko", "es", "de")])


@query(
    "epoch_repeat",
    """WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)
       SELECT unnest([1, 2, 3]) AS epoch, doc_id, pos FROM d""",
)
def epoch_repeat(spark, sf):
    return mix.epoch_repeat(mix.index_rows(documents(spark, sf), "doc_id", "pos"), 3).select("epoch", "doc_id", "pos")


# --- budgets ---------------------------------------------------------------------------------------


@query(
    "char_budget_exclusive",
    """SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, sum(length(text)) OVER (ORDER BY doc_id) AS run
       FROM documents WHERE lang = 'en') WHERE run <= 900000""",
)
def char_budget_exclusive(spark, sf):
    first, _ = pair(spark, sf)
    return mix.char_budget_exclusive(first, ["doc_id"], 900_000).select("doc_id", "n_chars")


@query(
    "char_budget_inclusive",
    """WITH c AS (SELECT doc_id, least(length(text), 10000) AS n FROM documents)
       SELECT doc_id, n FROM (SELECT doc_id, n, sum(n) OVER (ORDER BY doc_id) - n AS before FROM c) WHERE before <= 900000""",
)
def char_budget_inclusive(spark, sf):
    docs = documents(spark, sf).select("doc_id", mix.doc_cap().alias("text"))
    out = mix.char_budget_inclusive(docs, ["doc_id"], 900_000)
    return out.select("doc_id", F.length("text").cast("long").alias("n"))


@query(
    "val_budget",
    f"""WITH v AS (SELECT doc_id, text FROM documents WHERE lang = 'en' AND source = (SELECT max(source) FROM documents)),
      en AS (SELECT doc_id FROM (SELECT doc_id, sum(length(text)) OVER (ORDER BY doc_id) AS run FROM v) WHERE run <= 60000),
      {inserted('en')},
      sized AS (SELECT m.*, length(d.text) AS n FROM mixed m JOIN documents d USING (doc_id)),
      g AS (SELECT "group", sum(n) AS n FROM sized GROUP BY "group"),
      kept AS (SELECT "group" FROM (SELECT "group", sum(n) OVER (ORDER BY "group") - n AS before FROM g) WHERE before < 60000)
    SELECT doc_id, is_first, pos FROM sized WHERE "group" IN (SELECT "group" FROM kept)""",
)
def val_budget(spark, sf):
    first, second = pair(spark, sf)
    shard = documents(spark, sf).agg(F.max("source")).first()[0]
    sizes = mix.text_sizes(documents(spark, sf), ["doc_id"])
    out = mix.val_budget(first.filter(F.col("source") == shard), second, "doc_id", 0.3, 60_000, sizes=sizes)
    return out.select("doc_id", "is_first", "pos")


# --- corpus reports --------------------------------------------------------------------------------


@query(
    "mixture_composition",
    """SELECT coalesce(lang, 'ALL') AS lang, coalesce(source, 'ALL') AS source, count(*) AS n_docs,
              round(count(*) / (SELECT count(*) FROM documents), 6) AS share
       FROM documents GROUP BY ROLLUP (lang, source)""",
)
def mixture_composition(spark, sf):
    counts = documents(spark, sf).rollup("lang", "source").agg(F.count(F.lit(1)).alias("n_docs"))
    # the report has one row per language and source; the grand total is its own row
    total = documents(spark, sf).count()
    return counts.select(
        F.coalesce("lang", F.lit("ALL")).alias("lang"),
        F.coalesce("source", F.lit("ALL")).alias("source"),
        "n_docs",
        F.round(F.col("n_docs") / F.lit(total), 6).alias("share"),
    )


@query(
    "corpus_totals",
    """SELECT coalesce(lang, 'ALL') AS lang, coalesce(source, 'ALL') AS source, count(*) AS n_docs,
              CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(sum(octet_length(encode(text))) AS BIGINT) AS n_bytes,
              CAST(sum(length(text)) AS BIGINT) // 4 AS approx_tokens
       FROM documents GROUP BY ROLLUP (lang, source)""",
)
def corpus_totals(spark, sf):
    sums = documents(spark, sf).rollup("lang", "source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.length("text")).alias("n_chars"),
        F.sum(F.octet_length("text")).alias("n_bytes"),
    )
    return sums.withColumns(
        {
            "lang": F.coalesce("lang", F.lit("ALL")),
            "source": F.coalesce("source", F.lit("ALL")),
            "approx_tokens": F.expr("n_chars div 4"),
        }
    )


@query(
    "tokenizer_corpus",
    f"""WITH train AS (SELECT doc_id, lang, substr(text, 1, 10000) AS text FROM documents
                       WHERE source < (SELECT max(source) FROM documents) AND text <> ''),
      {SLOTS.format(docs='train')},
      run AS (SELECT doc_id, pos, length(text) AS n, sum(length(text)) OVER (ORDER BY pos) - length(text) AS before FROM mixed),
      kept AS (SELECT t.lang, r.n FROM run r JOIN train t USING (doc_id) WHERE before <= 1500000)
    SELECT lang, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_chars,
           round(sum(n) / (SELECT sum(n) FROM kept), 6) AS share FROM kept GROUP BY lang""",
)
def tokenizer_corpus(spark, sf):
    docs = scan.split_train_val(documents(spark, sf), "train", "source").filter(mix.nonempty())
    # ids and sizes are all that the mix and the budget need: the texts are read once, for this table
    docs = materialize(docs.select("doc_id", "lang", F.length(mix.doc_cap()).cast("long").alias("n")), "sizes")
    mixed = mix.ratio_mix(docs.filter(F.col("lang") == "en"), docs.filter(F.col("lang") != "en"), "doc_id", 0.7)
    sized = materialize(mixed.select("doc_id", "pos").join(docs, "doc_id").select("lang", "n", "pos"), "mix")
    kept = sized.filter(up_to(["pos"], budget_cutoff(sized, ["pos"], F.col("n"), 1_500_000, True)))
    by_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_chars"))
    share = F.col("n_chars") / F.sum("n_chars").over(Window.partitionBy())  # one row per language
    return by_lang.withColumn("share", F.round(share, 6))
