"""The thin query of every operator, over its whole table, and its SQL twin.

A query reads the given tables, calls its operator with the parameters of
production and derives the columns of its contract.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemscope.llm import bpe, lines, packing, pii, prefixes, quality, repair, secrets, sharding, simhash, toxicity, warc, winnowing
from itemscope.llm.common import ready, saved, shared_path, text_key

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# --- 6 quality rules ------------------------------------------------------------------------

@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger's measurements, failure bits and verdicts of two policies."""
    entries = quality.ledger(table(spark, sf_dir, "documents"))
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          (~quality.passes(quality.BASE)).alias("base_failed"), quality.passes(quality.FULL).alias("kept"),
                          F.col("failures").cast("int").alias("failures"))


ORACLE["op6_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
x AS (SELECT rid, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
g AS (SELECT rid, i, array_to_string(ws[i:i + 4], chr(31)) AS s FROM x),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM g) y WHERE c >= 2),
n AS (SELECT rid, sum(least(5, coalesce(nx - i, 5))) AS k FROM
        (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nx FROM r) z GROUP BY rid),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n.k, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
             length(t) - length(regexp_replace(t, '[A-ZÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ]', '', 'g')) AS n_upper
      FROM w LEFT JOIN n ON w.rid = n.rid),
b AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 10 * n_dup_lines > 4 * n_lines THEN 8 ELSE 0 END)
        + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END)
        + (CASE WHEN 2 * n_upper > word_chars THEN 64 ELSE 0 END) AS f FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f & 3) <> 0 AS base_failed, f = 0 AS kept,
       CAST(f AS INTEGER) AS failures FROM b"""


# --- 8 sharding -----------------------------------------------------------------------------

@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards by key, and where every row would be with nine: both versions of the map are
    stored and read back, and every row carries the bytes of its virtual slot."""
    items = saved(sharding.entries(table(spark, sf_dir, "documents")), "shard-entries")
    maps = shared_path(spark, "shard-maps")
    eight = sharding.first_map(spark, 8)
    sharding.save_map(eight, maps)
    sharding.save_map(sharding.grown(eight, 8), maps)
    loads = saved(sharding.slot_loads(items), "slot-loads")
    rows = sharding.place(items, sharding.load_map(spark, maps, 8), sharding.load_map(spark, maps, 9), loads)
    return rows.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                       "grown_shard", "virtual_slot", "map_version", "slot_bytes")


# --- 5 BPE encoding and decoding ------------------------------------------------------------

def _bpe_digests(batches):
    for b in batches:
        lists, texts = b.column("ids"), b.column("decoded")
        at = lists.offsets.to_numpy()
        numbers = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, lists.values.cast(pa.string())), " ")
        ids = [hashlib.sha256(x.as_buffer()).hexdigest() for x in numbers]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array((at[1:] - at[:-1]).astype("int64")), pa.array(ids, pa.string()),
             pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in texts], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every whole text's token ids and of their decoding."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.apply(docs, public_tokenizers.path("word_bpe_49k.json"), decoded="decoded", carry=["doc_id"],
                     then=_bpe_digests, then_schema="doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


# --- 1 SimHash near-duplicates --------------------------------------------------------------

@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = saved(simhash.with_fingerprint(docs, carry=["doc_id"]), "simhash")
    groups = simhash.near_duplicates(prints)
    return prints.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- 9 benchmark decontamination ------------------------------------------------------------

@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words hit and items found in every document, by winnowing and extension."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = winnowing.contamination(docs, table(spark, sf_dir, "benchmark"))
    counted = docs.select("doc_id", F.coalesce(F.regexp_count("text", F.lit(winnowing.WORD)), F.lit(0)).cast("bigint").alias("n_words"),
                          *text_key("text"))
    n_hit, items = F.coalesce("n_hit", F.lit(0)).cast("bigint"), F.coalesce("items", F.array().cast("array<string>"))
    return counted.join(found, ["k1", "k2"], "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


ORACLE["op9_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
ip AS (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM i WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(ws[s:s + n - 1], ' ') AS w FROM ip),
dp AS (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) k WHERE len(ws) >= n),
dw AS (SELECT rid, n, s, array_to_string(ws[s:s + n - 1], ' ') AS w FROM dp),
h AS (SELECT rid, s, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.w = iw.w),
c AS (SELECT rid, count(DISTINCT p) AS k FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM h) x GROUP BY rid),
t AS (SELECT rid, count(*) AS k, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM h) x GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(c.k, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.k, 0) AS BIGINT) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(c.k, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.rid = c.rid LEFT JOIN t ON d.rid = t.rid"""


# --- 4 fuzzy line deduplication -------------------------------------------------------------

@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text after fuzzy line deduplication, and how many lines went."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.deduplicate(docs, counts=True).select("doc_id", "n_lines", "n_dropped", "text")


# --- 3 WARC ---------------------------------------------------------------------------------

@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back, responses and revisits apart."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = warc.with_revisits(pages, "page_id", "payload")
    urn = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    archive = shared_path(warc.register(spark), "warc")
    rows.select(
        "record_type", urn("page_id").alias("record_id"), F.lit("2024-01-01T00:00:00Z").alias("warc_date"),
        F.col("url").alias("target_uri"), F.concat(F.lit("sha1:"), "payload_digest").alias("payload_digest"),
        F.when(revisit, urn("refers_to")).alias("refers_to"), F.when(revisit, warc.REVISIT_PROFILE).alias("profile"),
        "payload_length", F.create_map(F.lit("WARC-X-Page-ID"), F.col("page_id").cast("string")).alias("extra"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    ).write.format("warc").mode("append").save(archive)
    page = F.col("extra")["WARC-X-Page-ID"].cast("bigint").alias("page_id")
    # responses are hashed again from the payloads read; revisits are read without any block
    responses = spark.read.format("warc").load(archive).filter("record_type = 'response'").select(
        page, F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        "record_type", F.lit(None).cast("bigint").alias("refers_to"))
    revisits = spark.read.format("warc").option("payload", "false").load(archive).filter("record_type = 'revisit'").select(
        page, F.col("payload_length").alias("payload_bytes"), F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        "record_type", F.regexp_extract("refers_to", r"urn:x-page:(-?\d+)", 1).cast("bigint").alias("refers_to"))
    return responses.unionByName(revisits)


ORACLE["op3_warc"] = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_bytes, payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last THEN last END AS refers_to FROM g"""


# --- 7 secret scans -------------------------------------------------------------------------

@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of the plain kinds, and all spans with the confirmed ones."""
    found = secrets.with_spans(table(spark, sf_dir, "documents"), carry=["doc_id"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select("doc_id", *[count(k) for k in secrets.BASE_KINDS],
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


# --- 10 toxicity ----------------------------------------------------------------------------

@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents; the held-out fourth is never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_score(docs, model, carry=["doc_id"]).select(
        "doc_id", toxicity.is_held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


# --- 2 PII surrogates -----------------------------------------------------------------------

#: The key of the registered query; a deployment passes its own secret.
PII_KEY = b"itemscope registered query"


@query
def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates, and how many mentions were replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, PII_KEY, counts="n_replaced").select("doc_id", "n_replaced", "text")


# --- 11 best-fit packing ---------------------------------------------------------------------

@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece's place in a sequence of 2048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


# --- 12 conversation prefix trie ------------------------------------------------------------

#: Unsigned CRC-32 of the ASCII string ``{0}`` in SQL, bit by bit.
_CRC32 = ("xor(list_reduce(flatten(list_transform(string_split({0}, ''), lambda c: [CAST(unicode(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])), "
          "lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, 4294967295), 4294967295)")


def _joined_digests(batches):
    """sha256 of every node's pieces, which come in order, joined by commas."""
    at = digest = None
    for b in batches:
        out = []
        for k1, k2, ids in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
            if (k1, k2) == at:
                digest.update(b"," + ids.encode())
                continue
            if at is not None:
                out.append((*at, digest.hexdigest()))
            at, digest = (k1, k2), hashlib.sha256(ids.encode())
        yield _digest_batch(out)
    if at is not None:
        yield _digest_batch([(*at, digest.hexdigest())])


def _digest_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))],
                                      names=["k1", "k2", "ends_sha256"])


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie of the rebuilt conversations."""
    told = prefixes.turns(table(spark, sf_dir, "conversations"))
    c = F.col("conv_id")
    begun, lengths = prefixes.rebuilt(told, c - c % 5, F.crc32(c.cast("string").cast("binary")) % 9, 8)
    rows = prefixes.blocks(begun, lengths)
    pieces = saved(prefixes.joined_ids(prefixes.ends(rows)), "joined-ids")
    digests = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(
        _joined_digests, "k1 bigint, k2 bigint, ends_sha256 string")
    return prefixes.nodes(rows).join(digests, ["k1", "k2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


ORACLE["op12_prefix_trie"] = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
             {{{{'r': coalesce(role, ''), 't': coalesce(text, '')}}}} AS x FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(x ORDER BY pos) AS xs FROM t GROUP BY conv_id),
h AS (SELECT conv_id, xs, conv_id - conv_id % 5 AS base, {_CRC32.format("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM c),
r AS (SELECT h.conv_id, list_concat(coalesce(b.xs[1:h.h], []), h.xs[h.h + 1:]) AS xs FROM h LEFT JOIN c b ON h.base = b.conv_id),
p AS (SELECT conv_id, len(xs) AS n, unnest(range(len(xs) + 1)) AS d, xs FROM r),
q AS (SELECT conv_id, d, n, xs[1:d] AS path FROM p),
v AS (SELECT path, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) = any_value(d) AS leaf,
        CASE WHEN any_value(d) = 0 THEN 0 ELSE (count(*) - 1) * octet_length(encode(path[-1].t)) END AS saved,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
      FROM q GROUP BY path),
a AS (SELECT path[1:k] AS path, sum(saved) AS saved, sum(CASE WHEN leaf THEN 1 ELSE 0 END) AS leaves
      FROM (SELECT path, saved, leaf, unnest(range(d + 1)) AS k FROM v) y GROUP BY path[1:k]),
k AS (SELECT path[1:d - 1] AS path, count(*) AS children FROM v WHERE d > 0 GROUP BY path[1:d - 1])
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, v.n_convs, coalesce(k.children, 0) AS n_children,
       CAST(a.leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN a ON v.path = a.path LEFT JOIN k ON v.path = k.path LEFT JOIN v u ON v.d > 0 AND u.path = v.path[1:v.d - 1]""".replace("{{", "{").replace("}}", "}")


# --- 13 conversation structure repair -------------------------------------------------------

_REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _long_reports(conv_id, schema):
    """One report a conversation from its edited chunks, which come in order."""

    def report(conv, low, high, turns, counts, cost, audit, digest):
        gaps = 0 if low is None else high - low + 1 - turns
        return (conv, gaps, *counts, cost, "".join(audit), digest.hexdigest())

    def batch_of(out, types):
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=_REPORT)

    def run(batches):
        at, held, types = None, None, None
        for b in batches:
            types = types or [b.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            out = []
            for r in b.to_pylist():
                if r["conv"] != at:
                    if held:
                        out.append(report(*held))
                    at, written, tail = r["conv"], False, None
                    held = [r["conv_id"], None, None, 0, [0, 0, 0, 0], 0, [], hashlib.sha256()]
                if r["low"] is not None:
                    held[1] = r["low"] if held[1] is None else held[1]
                    held[2] = r["high"]
                held[3] += r["n_turns"]
                if r["head"] is not None:
                    held[4][3] += tail is not None and tail + r["head"] not in ("su", "ua", "au")
                    tail = r["tail"]
                for i, c in enumerate(("blank", "duplicate", "truncated", "illegal")):
                    held[4][i] += r[c]
                held[5] += r["cost"]
                held[6].append(r["audit"])
                for role, text in zip(r["roles"], r["texts"]):
                    held[7].update((("\n" if written else "") + role + ":" + text).encode())
                    written = True
            yield batch_of(out, types)
        if held:
            yield batch_of([report(*held)], types)

    return run


@query
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every damaged conversation."""
    fixed = repair.repair(repair.damaged(table(spark, sf_dir, "conversations")))
    said = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    whole = fixed.whole.select(
        "conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n_turns"), F.lit(0)).cast("bigint").alias("gaps"),
        *_REPORT[2:8], F.sha2(said.cast("binary"), 256).alias("repaired_sha256"))
    kind = fixed.parts.schema["conv_id"].dataType.simpleString()
    long = fixed.parts.repartition("conv").sortWithinPartitions("conv", F.desc("place")).mapInArrow(
        _long_reports("conv_id", _REPORT), f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in _REPORT[1:7]) + ", audit string, repaired_sha256 string")
    return whole.unionByName(long)


def _repair_sql() -> str:
    state = lambda s: f"{{'c': c{s}, 'a': a{s}, 'r': r{s}}}"
    move = lambda ok, cost, edit, role, to, text="x": (
        f"CASE WHEN {ok} THEN {{'c': c{to} + {cost}, 'a': '{edit}' || a{to}, "
        f"'r': {role} || ':' || {text} || CASE WHEN r{to} IS NULL THEN '' ELSE chr(10) || r{to} END}} END")
    cut = "CASE WHEN fault = 3 THEN 3 ELSE 0 END"
    columns = []
    for s in range(4):
        ways = [f"{{'c': c{s} + 4, 'a': 'D' || a{s}, 'r': r{s}}}"]
        for i, to in {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[s].items():
            ways.append(move(f"fault NOT IN (1, 2) AND i = '{i}'", cut, "K", "role", to))
        want, to = ("assistant", 3) if s == 2 else ("user", 2)
        ways.append(move(f"fault NOT IN (1, 2) AND i <> '{want[0]}'", f"3 + {cut}", "R", f"'{want}'", to))
        columns.append(f"list_min(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL)) AS p{s}")
    put = lambda v, role: f"{{'c': {v}.c + 3, 'a': 'I' || {v}.a, 'r': '{role}:' || CASE WHEN {v}.r IS NULL THEN '' ELSE chr(10) || {v}.r END}}"
    once = {0: put("p2", "user"), 1: put("p2", "user"), 2: put("p3", "assistant"), 3: put("p2", "user")}
    # two rows are put in between only on the way to an assistant row after a user row
    twice = "{'c': p3.c + 6, 'a': 'II' || p3.a, 'r': 'user:' || chr(10) || 'assistant:' || CASE WHEN p3.r IS NULL THEN '' ELSE chr(10) || p3.r END}"
    best = [f"list_min([p{s}, {once[s]}" + (f", {twice}" if s != 2 else "") + f"]) AS b{s}" for s in range(4)]
    parts = [f"b{s}.{f} AS {f}{s}" for s in range(4) for f in "car"]
    last = {0: "0 AS c0, '' AS a0, CAST(NULL AS VARCHAR) AS r0", 1: "6 AS c1, 'II' AS a1, 'user:' || chr(10) || 'assistant:' AS r1",
            2: "3 AS c2, 'I' AS a2, 'assistant:' AS r2", 3: "0 AS c3, '' AS a3, CAST(NULL AS VARCHAR) AS r3"}
    word = lambda c: f"coalesce(CAST({c} AS VARCHAR), ' ')"
    kind = _CRC32.format(f"({word('conv_id')} || ':' || {word('turn')})")
    return f"""
WITH RECURSIVE d AS (SELECT conv_id, turn, {word('role')} AS role, {word('text')} AS text, {kind} % 20 AS k FROM conversations),
e AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS x,
        unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM d WHERE k <> 0),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, x, copy) AS n,
        row_number() OVER (PARTITION BY conv_id, role, x ORDER BY turn NULLS FIRST, copy) AS seen, role[1] AS i FROM e),
g AS (SELECT conv_id, n, turn, role, x, i, lag(i) OVER (PARTITION BY conv_id ORDER BY n) AS before,
        CASE WHEN NOT regexp_matches(x, '[^\x20\x09-\x0D]') THEN 1 WHEN seen > 1 THEN 2
             WHEN NOT regexp_matches(x, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault FROM f),
s AS (SELECT conv_id, max(n) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank,
        count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated,
        count(*) FILTER (WHERE before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id),
w AS (SELECT conv_id, n, {', '.join(last.values())} FROM s
      UNION ALL
      SELECT conv_id, n, {', '.join(parts)} FROM (SELECT conv_id, n, {', '.join(best)} FROM (
        SELECT w.conv_id, w.n - 1 AS n, {', '.join(columns)}
        FROM w JOIN g ON w.conv_id IS NOT DISTINCT FROM g.conv_id AND w.n = g.n) y) z)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(c0, 0) AS BIGINT) AS cost,
       coalesce(a0, '') AS audit, sha256(coalesce(r0, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN s ON o.conv_id IS NOT DISTINCT FROM s.conv_id
LEFT JOIN (SELECT conv_id, c0, a0, r0 FROM w WHERE n = 0) b ON o.conv_id IS NOT DISTINCT FROM b.conv_id"""


ORACLE["op13_repair"] = _repair_sql()
