"""Pieces, byte-pair vocabularies, encoding, and rows of tokens over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import bpe, pack
from corpusloom.plans import fixtures as fx
from corpusloom.plans.chat import MERGED, rendered, sql_rendered
from corpusloom.plans.registry import query, sql_u, table
from corpusloom.session import new_dir
from corpusloom.sources import scan
from corpusloom.sources.scan import spread

TOK = tx.ByteTokenizer()
N_MERGES = 12
VOCAB = 256 + N_MERGES + len(tx.SPECIAL_TOKENS)
#: ids of the vocabulary of the ``vocab_`` queries, far too many merges for a statement of one step each
LARGE_VOCAB = 4096
#: ids of the vocabulary that ``tokenizer_compare`` trains, the size that the reference trains by default
FULL_VOCAB = 32_768

# SQL has no look-ahead, so white space is collapsed first; the pieces are then the same
PATTERN = r"""''(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,2}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s+"""
COLLAPSED = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
PIECES = f"""pieces AS (SELECT doc_id, lang, unnest(regexp_extract_all({COLLAPSED}, '{PATTERN}')) AS piece,
  unnest(range(len(regexp_extract_all({COLLAPSED}, '{PATTERN}')))) AS pos FROM documents)"""


def documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return spread(docs, "doc_id")


def collapsed(spark, sf):
    docs = documents(spark, sf)
    return docs.withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " ")))


def sql_training(n: int) -> str:
    """The first ``n`` merges, one step after the other, on the table of distinct pieces."""
    steps = f"""{PIECES},
  counts AS (SELECT piece, count(*) AS n FROM pieces GROUP BY piece),
  w0 AS MATERIALIZED (SELECT piece, n, array_to_string(list_transform({fx.sql_bytes('piece')}, lambda b: chr(b)), '') AS w FROM counts),
  l0 AS (SELECT list_transform(range(256), lambda i: 1) AS sizes)"""
    for i in range(n):
        steps += f""",
  m{i} AS MATERIALIZED (SELECT substr(w, CAST(j AS INT), 2) AS pair, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT w, n, unnest(range(1, length(w))) AS j FROM w{i}) GROUP BY pair ORDER BY n DESC, pair LIMIT 1),
  w{i + 1} AS MATERIALIZED (SELECT piece, w.n, replace(w, (SELECT pair FROM m{i}), chr({256 + i})) AS w FROM w{i} w),
  l{i + 1} AS (SELECT list_append(sizes, sizes[unicode(substr(pair, 1, 1)) + 1] + sizes[unicode(substr(pair, 2, 1)) + 1]) AS sizes
    FROM l{i}, m{i})"""
    return steps


TRAINING = sql_training(N_MERGES)


def sql_trained(vocab: int) -> str:
    """All merges of a vocabulary on the table of distinct pieces, as a recursion that leaves the merged ``words``; the row of the empty piece counts the merges.

    A step takes the pairs that share the highest count, in order, up to the first that a merge before it would disturb. What a step makes cannot
    come between them: a pair with a new symbol on the left sorts behind, and one (z, new) that has the highest count stands for a
    pair (z, left) with that count, which sorts at the same place and has ended the step.
    """
    return f"""{PIECES},
  counts AS (SELECT piece, count(*) AS n FROM pieces GROUP BY piece),
  words(piece, n, w) USING KEY (piece) AS (
    SELECT piece, n, array_to_string(list_transform({fx.sql_bytes('piece')}, lambda b: chr(b)), '') FROM counts UNION ALL SELECT '', 0, ''
    UNION
    (WITH spots AS MATERIALIZED (SELECT piece, w, n, substr(w, CAST(j AS INT), 2) AS pair
        FROM (SELECT piece, w, n, unnest(range(1, length(w))) AS j FROM recurring.words)),
      sums AS MATERIALIZED (SELECT pair, sum(n) AS n FROM spots GROUP BY pair),
      top AS MATERIALIZED (SELECT pair, substr(pair, 1, 1) AS l, substr(pair, 2, 1) AS r, row_number() OVER (ORDER BY pair) AS i
        FROM sums WHERE n = (SELECT max(n) FROM sums)),
      stops AS (SELECT t.i FROM top t JOIN (SELECT r, min(i) AS i FROM top GROUP BY r) s ON s.r = t.l AND s.i < t.i
        UNION ALL SELECT t.i FROM top t JOIN (SELECT l, min(i) AS i FROM top GROUP BY l) s ON s.l = t.r AND s.i < t.i),
      done AS (SELECT n AS merges FROM recurring.words WHERE piece = ''),
      chosen AS MATERIALIZED (SELECT pair, chr(CAST(255 + merges + i AS INT)) AS made FROM top, done
        WHERE i < coalesce((SELECT min(i) FROM stops), i + 1) AND merges + i <= {vocab - 256 - len(tx.SPECIAL_TOKENS)})
    SELECT piece, any_value(n), list_reduce(list(DISTINCT pair || made), lambda a, x: replace(a, x[1:2], x[3]), any_value(w))
    FROM spots JOIN chosen USING (pair) GROUP BY piece
    UNION ALL SELECT '', merges + (SELECT count(*) FROM chosen), '' FROM done WHERE EXISTS (FROM chosen)))"""


# merges by the files they were learned from and the vocabulary size, so that changed files are learned from anew
_trained: dict[tuple, list[tuple[int, int]]] = {}


def train(spark, sf, vocab=VOCAB):
    """Learn the merges from all documents of the folder and keep them for the other queries."""
    files = scan.file_states(spark, f"{sf}/documents.parquet")
    _trained[files, vocab] = bpe.train_merges(bpe.piece_counts(collapsed(spark, sf)), vocab)
    return _trained[files, vocab]


def trained(spark, sf, vocab=VOCAB):
    return _trained.get((scan.file_states(spark, f"{sf}/documents.parquet"), vocab)) or train(spark, sf, vocab)


def tokenizer(spark, sf, vocab=VOCAB):
    return bpe.BpeTokenizer(trained(spark, sf, vocab))


# --- pieces and training ---------------------------------------------------------------------------


@query("pretokenize", f"WITH {PIECES} SELECT doc_id, pos, piece FROM pieces")
def pretokenize(spark, sf):
    rows = collapsed(spark, sf).select("doc_id", F.posexplode_outer(tx.pieces("text")).alias("pos", "piece")).filter("piece IS NOT NULL")
    return rows.withColumn("pos", F.col("pos").cast("long"))


@query("token_frequency", f"WITH {PIECES} SELECT piece, count(*) AS n FROM pieces GROUP BY piece")
def token_frequency(spark, sf):
    return bpe.piece_counts(collapsed(spark, sf))


@query(
    "pair_counts",
    f"""WITH {sql_training(0)},
      p AS (SELECT substr(w, CAST(j AS INT), 2) AS pair, n FROM (SELECT w, n, unnest(range(1, length(w))) AS j FROM w0))
    SELECT unicode(substr(pair, 1, 1)) AS left_id, unicode(substr(pair, 2, 1)) AS right_id, CAST(sum(n) AS BIGINT) AS n
    FROM p GROUP BY pair""",
)
def pair_counts(spark, sf):
    pairs = bpe.pair_counts(bpe.to_words(bpe.piece_counts(collapsed(spark, sf))))
    return pairs.select(F.ascii("pair").alias("left_id"), F.ascii(F.substring("pair", 2, 1)).alias("right_id"), "n")


@query(
    "bpe_train",
    f"WITH {TRAINING} "
    + " UNION ALL ".join(
        f"SELECT {i} AS rank, unicode(substr(pair, 1, 1)) AS left_id, unicode(substr(pair, 2, 1)) AS right_id, {256 + i} AS new_id FROM m{i}"
        for i in range(N_MERGES)
    ),
)
def bpe_train(spark, sf):
    return bpe.merge_table(spark, train(spark, sf))


# --- vocabulary ------------------------------------------------------------------------------------

VOCAB_SQL = f"""WITH {TRAINING},
  v AS (SELECT unnest(range({256 + N_MERGES})) AS token_id, unnest(sizes) AS n_bytes FROM l{N_MERGES}),
  vocab AS (SELECT CAST(token_id AS INT) AS token_id, n_bytes, false AS is_special FROM v
            UNION ALL SELECT CAST({256 + N_MERGES} + i AS INT), 0, true FROM range(9) t(i))"""


@query("token_n_bytes", f"{VOCAB_SQL} SELECT token_id, n_bytes, is_special FROM vocab")
def token_n_bytes(spark, sf):
    return bpe.vocab_table(spark, trained(spark, sf)).select("token_id", "n_bytes", "is_special")


@query("token_bytes_sink", f"{VOCAB_SQL} SELECT token_id, n_bytes FROM vocab")
def token_bytes_sink(spark, sf):
    path = new_dir(spark, "token-bytes")
    vocab = bpe.vocab_table(spark, trained(spark, sf))
    vocab.select("token_id", "n_bytes").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query(
    "token_byte_stats",
    f"""{VOCAB_SQL} SELECT min(n_bytes) AS n_min, max(n_bytes) AS n_max, round(avg(n_bytes), 6) AS n_mean,
          round(stddev_samp(n_bytes), 6) AS n_std, (SELECT count(*) FROM vocab WHERE is_special) AS n_special
        FROM vocab WHERE n_bytes > 0""",
)
def token_byte_stats(spark, sf):
    vocab = bpe.vocab_table(spark, trained(spark, sf))
    n = F.when(F.col("n_bytes") > 0, F.col("n_bytes"))
    return vocab.agg(
        F.min(n).alias("n_min"), F.max(n).alias("n_max"), F.round(F.avg(n), 6).alias("n_mean"),
        F.round(F.stddev_samp(n), 6).alias("n_std"), F.count_if("is_special").alias("n_special"),
    )


@query(
    "tokenizer_store",
    f"""WITH {TRAINING} SELECT unnest({fx.sql_strings(tx.SPECIAL_TOKENS)}) AS name,
          CAST(unnest(range(9)) + (SELECT len(sizes) FROM l{N_MERGES}) AS INT) AS token_id""",
)
def tokenizer_store(spark, sf):
    path = new_dir(spark, "tokenizer")
    bpe.save_tokenizer(spark, trained(spark, sf), path, mode="overwrite")
    again = bpe.load_merges(spark, path)
    return bpe.vocab_table(spark, again).filter("is_special").select("name", "token_id")


# --- encoding --------------------------------------------------------------------------------------

ENCODED = f"""{TRAINING},
  encoded AS (SELECT doc_id, lang, pos, list_transform(string_split(w, ''), lambda c: unicode(c)) AS ids
              FROM pieces JOIN w{N_MERGES} USING (piece))"""


@query(
    "bpe_encode",
    f"""WITH {ENCODED}, d AS (SELECT doc_id, list_concat([{256 + N_MERGES}], flatten(list(ids ORDER BY pos))) AS ids FROM encoded GROUP BY doc_id)
    SELECT doc_id, len(ids) AS n_tokens, md5({fx.sql_join('ids')}) AS ids FROM d""",
)
def bpe_encode(spark, sf):
    tok = tokenizer(spark, sf)
    rows = collapsed(spark, sf).select("doc_id", tok.encode("text", prepend=tok.special(tx.BOS)).alias("ids"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.md5(fx.joined("ids")).alias("ids"))


@query("bpe_decode", "SELECT doc_id, text FROM documents")
def bpe_decode(spark, sf):
    tok = tokenizer(spark, sf)
    return documents(spark, sf).select("doc_id", tok.decode(tok.encode("text")).alias("text"))


@query(
    "tokenizer_callable",
    f"WITH {ENCODED} SELECT doc_id, CAST(sum(len(ids)) AS BIGINT) AS n_tokens, CAST(2 AS BIGINT) AS n_texts FROM encoded GROUP BY doc_id",
)
def tokenizer_callable(spark, sf):
    tokenizer(spark, sf).register(spark, "bpe_encode")
    collapsed(spark, sf).createOrReplaceTempView("doc_texts")
    return spark.sql("SELECT doc_id, CAST(size(bpe_encode(text)) AS BIGINT) AS n_tokens, CAST(size(bpe_encode_each(array(text, ''))) AS BIGINT) AS n_texts FROM doc_texts")


@query(
    "compression_ratio",
    f"""WITH {ENCODED}, t AS (SELECT lang, CAST(sum(len(ids)) AS BIGINT) AS n_tokens FROM encoded GROUP BY lang),
      b AS (SELECT lang, CAST(sum(octet_length(encode({COLLAPSED}))) AS BIGINT) AS n_bytes FROM documents GROUP BY lang)
    SELECT lang, n_bytes, n_tokens, round(n_bytes / n_tokens, 6) AS ratio, CAST(0 AS BIGINT) AS n_broken FROM t JOIN b USING (lang)""",
)
def compression_ratio(spark, sf):
    return ratios(collapsed(spark, sf), tokenizer(spark, sf), "lang")


def ratios(docs, tok, by):
    """Bytes per token of every group, and how many texts do not survive the round trip."""
    ids = docs.select(by, "text", tok.encode("text").alias("ids"))
    rows = ids.select(by, "text", F.size("ids").alias("n"), tok.decode("ids").alias("back"))
    return rows.groupBy(by).agg(
        F.sum(F.octet_length("text")).alias("n_bytes"),
        F.sum("n").alias("n_tokens"),
        F.round(F.sum(F.octet_length("text")) / F.sum("n"), 6).alias("ratio"),
        F.count_if(F.col("text") != F.col("back")).alias("n_broken"),
    )


@query(
    "tokenizer_compare",
    f"""WITH RECURSIVE {sql_trained(FULL_VOCAB)}, t AS (SELECT lang, CAST(sum(length(w)) AS BIGINT) AS ours FROM pieces JOIN words USING (piece) GROUP BY lang),
      b AS (SELECT lang, CAST(sum(octet_length(encode({COLLAPSED}))) AS BIGINT) AS baseline FROM documents GROUP BY lang)
    SELECT lang, baseline AS baseline_tokens, ours AS our_tokens, round(100.0 * (baseline - ours) / CAST(baseline AS DOUBLE), 6) AS diff_pct,
      CASE WHEN ours < baseline THEN 'ours' WHEN ours > baseline THEN 'baseline' ELSE 'tie' END AS better FROM t JOIN b USING (lang)""",
)
def tokenizer_compare(spark, sf):
    """A whole vocabulary against one id per byte. Token counts by tokenizer are one row per language, joined by language."""
    tok = tokenizer(spark, sf, FULL_VOCAB)
    ours = collapsed(spark, sf).groupBy("lang").agg(F.sum(F.size(tok.encode("text"))).alias("our_tokens"))
    base = collapsed(spark, sf).groupBy("lang").agg(F.sum(F.octet_length("text")).alias("baseline_tokens"))
    a, b = F.col("baseline_tokens"), F.col("our_tokens")
    return base.join(ours, "lang").select(
        "lang", "baseline_tokens", "our_tokens", F.round(100.0 * (a - b) / a, 6).alias("diff_pct"),
        F.when(b < a, "ours").when(b > a, "baseline").otherwise("tie").alias("better"),
    )


# --- a large vocabulary, compared with plain models in the tests -----------------------------------


@query("vocab_train")
def vocab_train(spark, sf):
    return bpe.merge_table(spark, train(spark, sf, LARGE_VOCAB))


@query("vocab_encode")
def vocab_encode(spark, sf):
    """The ids of every text, and whether they decode to it."""
    tok = tokenizer(spark, sf, LARGE_VOCAB)
    rows = documents(spark, sf).select("doc_id", "text", tok.encode("text", prepend=tok.special(tx.BOS)).alias("ids"))
    back = tok.decode(F.slice("ids", F.lit(2), F.size("ids"))) == F.col("text")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.md5(fx.joined("ids")).alias("ids"), back.alias("is_whole"))


@query("vocab_compression")
def vocab_compression(spark, sf):
    return ratios(documents(spark, sf), tokenizer(spark, sf, LARGE_VOCAB), "lang")


# --- rows of tokens --------------------------------------------------------------------------------

T, B = 2048, 4
PACKERS = 8


def byte_ids():
    return F.concat(F.array(F.lit(TOK.special(tx.BOS))), TOK.encode("text"))


def byte_docs(spark, sf):
    return documents(spark, sf).select("doc_id", byte_ids().alias("ids"))


@query(
    "flat_token_rows",
    f"""WITH d AS (SELECT doc_id, list_concat([256], {fx.sql_bytes('text')}) AS ids FROM documents),
      o AS (SELECT doc_id, ids, sum(len(ids)) OVER (ORDER BY doc_id) - len(ids) AS start FROM d),
      s AS (SELECT CAST(start AS BIGINT) + unnest(range(len(ids))) AS p, unnest(ids) AS id FROM o),
      n AS (SELECT ((count(*) - 1) // {T * B}) * {B} AS n_rows FROM s),
      w AS (SELECT p // {T} AS row_id, p, id FROM s UNION ALL SELECT p // {T} - 1, p, id FROM s WHERE p % {T} = 0 AND p > 0),
      r AS (SELECT row_id, list(id ORDER BY p) AS ids FROM w GROUP BY row_id)
    SELECT row_id, md5({fx.sql_join(f'ids[:{T}]')}) AS inputs, md5({fx.sql_join('ids[2:]')}) AS targets
    FROM r WHERE row_id < (SELECT n_rows FROM n)""",
)
def flat_token_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = pack.flat_rows(docs, "doc_id", byte_ids(), T, B, size=F.octet_length("text") + 1)
    return rows.select("row_id", F.md5(fx.joined("inputs")).alias("inputs"), F.md5(fx.joined("targets")).alias("targets"))


def sql_packed(docs: str, packers: int | None, width: int, buffer: int, refill: int, crop: str, finish: bool = True) -> str:
    """Best-fit packing as a recursion: every step admits sequences or places one. ``docs`` has (key, ids), and grp where the number of ``packers`` is None."""
    grp = "grp" if packers is None else f"CAST(floor({sql_u('pack', 'key')} * {packers}) AS BIGINT)"
    cap, big = width + 1, 1 << 32
    fit = "list_filter(buf, lambda x: x.n <= room)"
    longest = f"list_max(list_transform({fit}, lambda x: x.n * {big} - x.a))"
    cropped = {
        "shortest": f"list_min(list_transform(buf, lambda x: x.n * {big} + x.a)) % {big}",
        "first": "list_min(list_transform(buf, lambda x: x.a))",
    }[crop]
    usable = "total" if finish else f"total // {refill} * {refill}"
    go_on = "len(buf) > 0 OR nxt < usable" if finish else f"len(buf) >= {buffer} OR nxt < usable"
    return f"""
  src AS (SELECT *, len(ids) AS n, row_number() OVER (PARTITION BY grp ORDER BY key) - 1 AS a, count(*) OVER (PARTITION BY grp) AS total
          FROM (SELECT key, ids, {grp} AS grp FROM {docs})),
  queues AS (SELECT grp, list({{'n': n, 'a': a}} ORDER BY a) AS q, any_value({usable}) AS usable FROM src GROUP BY grp),
  pack AS (
    SELECT grp, 0 AS step, q[1:0] AS buf, CAST(0 AS BIGINT) AS nxt, CAST({cap} AS BIGINT) AS room, CAST(0 AS BIGINT) AS row_id,
           CAST(-1 AS BIGINT) AS pick, CAST(0 AS BIGINT) AS take, CAST(0 AS BIGINT) AS placed FROM queues
    UNION ALL
    SELECT grp, step + 1, CASE WHEN admit THEN list_concat(buf, q[nxt + 1:least(nxt + {refill}, usable)]) ELSE list_filter(buf, lambda x: x.a <> chosen) END,
           CASE WHEN admit THEN least(nxt + {refill}, usable) ELSE nxt END,
           CASE WHEN admit THEN room WHEN room = used THEN {cap} ELSE room - used END,
           CASE WHEN NOT admit AND room = used THEN row_id + 1 ELSE row_id END,
           CASE WHEN admit THEN -1 ELSE chosen END, CASE WHEN admit THEN 0 ELSE used END, row_id
    FROM (SELECT *, least(room, list_filter(buf, lambda x: x.a = chosen)[1].n) AS used
          FROM (SELECT p.*, q.q, q.usable, len(buf) < {buffer} AND nxt < usable AS admit,
                       CASE WHEN len({fit}) > 0 THEN ({big} - {longest} % {big}) % {big} ELSE {cropped} END AS chosen
                FROM pack p JOIN queues q USING (grp) WHERE {go_on}))),
  packed AS (SELECT p.grp AS pack_group, p.placed AS row_id, count(*) AS n_docs, CAST(sum(s.n - p.take) AS BIGINT) AS n_cropped,
                    flatten(list(s.ids[:p.take] ORDER BY p.step)) AS ids, {fx.sql_join('list(s.key ORDER BY p.step)')} AS docs
             FROM pack p JOIN src s ON s.grp = p.grp AND s.a = p.pick WHERE p.pick >= 0 GROUP BY p.grp, p.placed HAVING sum(p.take) = {cap})"""


SHOWN = f"pack_group, row_id, n_docs, n_cropped, docs, md5({fx.sql_join('ids')}) AS ids"
SQL_DOCS = f"bytes AS (SELECT doc_id AS key, list_concat([256], {fx.sql_bytes('text')}) AS ids FROM documents)"
PACKED = f"{SQL_DOCS}, {sql_packed('bytes', PACKERS, T, 1000, 128, 'shortest')}"


def shown(packed):
    return packed.select(
        "pack_group", "row_id", F.size("doc_ids").cast("long").alias("n_docs"), "n_cropped",
        fx.joined("doc_ids").alias("docs"), F.md5(fx.joined("ids")).alias("ids"),
    )


def packed(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return pack.bestfit_pack(docs, "doc_id", byte_ids(), T, pack.pack_groups(PACKERS, "doc_id"))


@query("bestfit_pack", f"WITH RECURSIVE {PACKED} SELECT {SHOWN} FROM packed")
def bestfit_pack(spark, sf):
    return shown(packed(spark, sf))


@query("pack_in_parts", f"WITH RECURSIVE {PACKED} SELECT {SHOWN} FROM packed")
def pack_in_parts(spark, sf):
    """The rows of one run, from three that go on from each other's state."""
    docs = documents(spark, sf).select("doc_id", "text")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    cuts = [low, low + (high - low) // 5, low + (high - low) // 2, high + 1]
    state, parts = None, []
    for begin, end in zip(cuts, cuts[1:]):
        part = docs.filter((F.col("doc_id") >= begin) & (F.col("doc_id") < end))
        rows, state = pack.pack_part(part, "doc_id", byte_ids(), T, pack.pack_groups(PACKERS, "doc_id"), state, last=end > high)
        parts.append(rows)
    return shown(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query(
    "bestfit_pack_conv",
    f"""WITH RECURSIVE {MERGED}, {sql_rendered('merged')}, conv AS (SELECT conv_id AS key, ids FROM rendered),
      {sql_packed('conv', PACKERS, T, 100, 1, 'first')}
    SELECT {SHOWN} FROM packed""",
)
def bestfit_pack_conv(spark, sf):
    groups = pack.pack_groups(PACKERS, "conv_id")
    return shown(pack.bestfit_pack(rendered(spark, sf), "conv_id", "ids", T, groups, buffer=100, refill=1, crop="first"))


@query("packer_udtf", f"WITH RECURSIVE {PACKED} SELECT {SHOWN} FROM packed")
def packer_udtf(spark, sf):
    docs = byte_docs(spark, sf)
    spark.udtf.register("pack_rows", pack.packer_function(T))
    groups = pack.pack_groups(PACKERS, "doc_id")
    docs.select(F.col("doc_id").alias("doc"), "ids", groups.alias("pack_group")).createOrReplaceTempView("pack_input")
    return shown(spark.sql("SELECT * FROM pack_rows(TABLE(pack_input) PARTITION BY pack_group ORDER BY doc)"))


@query(
    "packing_waste",
    f"""WITH d AS (SELECT lang, 1 + octet_length(encode(text)) AS n FROM documents)
    SELECT lang, CAST(sum(n) AS BIGINT) AS n_tokens, CAST(sum(greatest(n - {T + 1}, 0)) AS BIGINT) AS min_cropped,
           round(sum(greatest(n - {T + 1}, 0)) / sum(n), 6) AS min_crop FROM d GROUP BY lang""",
)
def packing_waste(spark, sf):
    return pack.packing_minimum(table(spark, sf, "documents"), F.octet_length("text") + 1, T, "lang")


@query(
    "packing_rates",
    f"""WITH RECURSIVE {PACKED}, s AS (SELECT count(*) AS n_rows, CAST(sum(len(ids)) AS BIGINT) AS n_packed, CAST(sum(n_cropped) AS BIGINT) AS n_cropped FROM packed)
    SELECT n_rows, n_packed, n_cropped, CAST(1 AS DOUBLE) AS utilization, CAST(0 AS DOUBLE) AS padding, round(n_cropped / (n_packed + n_cropped), 6) AS crop,
           (SELECT CAST(sum(n) AS BIGINT) FROM src) - n_packed - n_cropped AS n_leftover FROM s""",
)
def packing_rates(spark, sf):
    total = table(spark, sf, "documents").agg(F.sum(F.octet_length("text") + 1)).first()[0]
    rates = pack.packing_rates(packed(spark, sf), total, T)
    return rates.withColumns({c: F.round(c, 6) for c in ("utilization", "padding", "crop")})
