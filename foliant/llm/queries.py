"""The registered queries of the operators: each applies one to its whole table with production parameters.

``QUERIES``: name to callable (spark, sf_dir). ``ORACLE``: DuckDB SQL for those that SQL can express; the others are
tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import byte_bpe, conversation_trie, decontaminate, html_text, merkle, near_dedup, quality_classifier, quality_rules, secret_scan, sharding, substring_dedup, token_counts, token_files
from foliant.llm.common import table
from foliant.scale import scratch_path

#: Tokens of a training context; longer documents are marked.
TOKEN_LIMIT = 4096
#: Bytes of text in a shard: one range read of an object store. Raise it for archives that are read as a whole.
SHARD_BYTES = 1 << 20


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, through a cache that this run fills."""
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), scratch_path(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def digests_of_ids(encoded: DataFrame) -> DataFrame:
    """``n_tokens``, the digest of the decimal ids and the digest of the decoded bytes beside the other columns."""
    return (
        byte_bpe.decode(encoded)
        .withColumn("n_tokens", F.size("ids").cast("long"))
        .withColumn("ids_sha256", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256))
        .withColumn("decoded_sha256", F.sha2("bytes", 256))
        .drop("bytes")
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they stand for, as digests."""
    return digests_of_ids(byte_bpe.encode(table(spark, sf_dir, "documents"))).drop("ids")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, with what the shard holds."""
    return sharding.shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def judged_documents(spark: SparkSession, docs: DataFrame, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """Quality verdicts; trusted are the documents labelled good and not toxic."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    return quality_rules.judged(docs, quality_rules.log_ratios(docs, trusted), keep=keep)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return judged_documents(spark, table(spark, sf_dir, "documents"), sf_dir, ["doc_id"])


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it is read back from the token files that this run writes."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    found = token_files.read_token_files(spark, path).withColumn("n_tokens", F.size("ids").cast("long"))
    return token_files.checksums(found)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels as grades: 0 junk, 1 fluent but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return table(spark, sf_dir, "labels").select("doc_id", grade.alias("grade"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and selection of every document, by a model of its labelled ones."""
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.graded(docs, *quality_classifier.trained(docs, ratings(spark, sf_dir)), keep=["doc_id"])


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and places of the fixed patterns, and all places."""
    found = secret_scan.secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", of_kind("assign"), of_kind("access"), of_kind("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), of_kind("random"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document and those that lie in repeated passages."""
    found = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("repeats", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items, and the items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests and proof of every document, each fifth (by checksum of its id) checked after its capitals were lowered."""
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    fields = {"doc_id": F.col("doc_id"), "source": F.col("source"), "lang": F.col("lang"), "n_chars": F.col("n_chars"), "text": lowered}
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.verified(docs, tuple(fields), tampered=F.when(chosen, merkle.digest(*fields.values())))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, after each hundred of them got first turns in common."""
    turns = conversation_trie.turns(table(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("c").cast("string").cast("binary")) % 6
    return conversation_trie.trie(*conversation_trie.spliced(turns, head, F.col("c") - F.col("c") % 100)).drop("d")


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extracted(table(spark, sf_dir, "pages"), ["page_id", "url"])


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_byte_bpe,
        op3_sharding,
        op4_quality_rules,
        op5_near_duplicates,
        op6_token_files,
        op7_quality_classifier,
        op8_secret_scan,
        op9_substring_dedup,
        op10_decontamination,
        op11_merkle_manifest,
        op12_conversation_trie,
        op13_html_extraction,
    )
}



def _crc32(number: str) -> str:
    """DuckDB SQL for the checksum of a number's decimal digits."""
    digits = f"list_transform(range(1, length(CAST({number} AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST({number} AS VARCHAR), i, 1)) AS UBIGINT))"
    shifted = "list_reduce(list_prepend(xor(a, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS UBIGINT[])), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), {digits}), lambda a, b: {shifted}), CAST(4294967295 AS UBIGINT))"


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


_LEAF = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))

_ITEM_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op3_sharding": f"""
WITH k AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes, CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM documents),
p AS (SELECT doc_id, n_bytes, depth, h >> (60 - depth) AS node FROM (SELECT *, unnest(range(0, 41)) AS depth FROM k)),
t AS (SELECT depth, node, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY ALL),
f AS (SELECT p.doc_id, p.n_bytes, p.depth, p.node, t.shard_bytes, t.shard_rows FROM p JOIN t USING (depth, node) WHERE t.shard_bytes <= {SHARD_BYTES} OR t.shard_rows = 1)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(node), CAST(depth AS INTEGER), '0') END AS shard, CAST(depth AS INTEGER) AS depth, shard_bytes, shard_rows
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS r FROM f) WHERE r = 1""",
    "op5_near_duplicates": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.doc_id)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op9_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
r AS (SELECT doc_id, s, array_to_string(list_slice(w, s, s + 34), ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)),
twice AS (SELECT run FROM r GROUP BY run HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM r SEMI JOIN twice USING (run)),
words AS (SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op10_decontamination": f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, list_slice(w, s, s + 9) AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS k FROM iw),
dw AS (SELECT doc_id, s, k, list_slice(w, s, s + k - 1) AS win FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, sizes)),
occ AS (SELECT doc_id, s, k, item_id FROM dw JOIN iw USING (win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE d AS (SELECT doc_id, source, sha256({_LEAF} || {_field('text')}) AS leaf,
  sha256({_LEAF} || {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS lowered, {_crc32('doc_id')} % 5 = 0 AS chosen FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM d),
g AS (SELECT 0 AS lvl, source, place AS i, n, leaf AS h FROM leaves
  UNION ALL SELECT lvl + 1, source, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM g WHERE n > 1 GROUP BY lvl, source, i // 16, n),
subroots AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spot, count(*) OVER () AS many FROM g WHERE n = 1),
s AS (SELECT 0 AS lvl, spot AS i, many AS n, subroot AS h FROM subroots
  UNION ALL SELECT lvl + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM s WHERE n > 1 GROUP BY lvl, i // 16, n),
gw AS (SELECT l.source, place, g.lvl, string_agg(h, '' ORDER BY g.i) FILTER (g.i < (place >> (4 * g.lvl))) AS b, string_agg(h, '' ORDER BY g.i) FILTER (g.i > (place >> (4 * g.lvl))) AS a
  FROM leaves l JOIN g ON g.source IS NOT DISTINCT FROM l.source AND g.n > 1 AND g.i >> 4 = (place >> (4 * g.lvl + 4)) GROUP BY l.source, place, g.lvl),
sw AS (SELECT source, s.lvl, string_agg(h, '' ORDER BY s.i) FILTER (s.i < (spot >> (4 * s.lvl))) AS b, string_agg(h, '' ORDER BY s.i) FILTER (s.i > (spot >> (4 * s.lvl))) AS a
  FROM subroots JOIN s ON s.n > 1 AND s.i >> 4 = (spot >> (4 * s.lvl + 4)) GROUP BY source, s.lvl),
gl AS (SELECT source, place, list([coalesce(b, ''), coalesce(a, '')] ORDER BY lvl) AS ways FROM gw GROUP BY source, place),
sl AS (SELECT source, list([coalesce(b, ''), coalesce(a, '')] ORDER BY lvl) AS ways FROM sw GROUP BY source),
w AS (SELECT doc_id, leaf, CASE WHEN chosen THEN lowered ELSE leaf END AS checked, subroot, (SELECT h FROM s WHERE n = 1) AS root, list_concat(coalesce(gl.ways, []), coalesce(sl.ways, [])) AS ways
  FROM leaves l JOIN subroots r ON r.source IS NOT DISTINCT FROM l.source LEFT JOIN gl ON gl.source IS NOT DISTINCT FROM l.source AND gl.place = l.place LEFT JOIN sl ON sl.source IS NOT DISTINCT FROM l.source),
f AS (SELECT *, sha256(array_to_string(flatten(ways), '')) AS proof_sha256, list_reduce(list_prepend([checked, ''], ways), lambda x, y: [sha256(y[1] || x[1] || y[2]), ''])[1] AS folded_root FROM w)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f""",
    "op12_conversation_trie": f"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, unhex(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS d
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, d, length(text) AS chars, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, d) - 1 AS pos FROM t),
h AS (SELECT c, {_crc32('c')} % 6 AS h, c - c % 100 AS p FROM (SELECT DISTINCT c FROM o)),
u AS (SELECT h.c, 0 AS part, pos, d, chars FROM h JOIN o ON o.c = h.p AND pos < h UNION ALL SELECT h.c, 1, pos, d, chars FROM h JOIN o ON o.c = h.c AND pos >= h),
r AS (SELECT c, row_number() OVER w AS depth, sha256(string_agg(hex(d), '') OVER w) AS node, chars FROM u WINDOW w AS (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING)),
path AS (SELECT c, 0 AS depth, '' AS node, 0 AS chars FROM h UNION ALL SELECT c, depth, node, chars FROM r),
n AS (SELECT node, depth, min(c) AS rep, count(*) AS n, any_value(chars) AS chars FROM path GROUP BY node, depth),
kids AS (SELECT a.node AS parent, b.node FROM path a JOIN path b ON b.c = a.c AND b.depth = a.depth + 1 GROUP BY ALL),
nk AS (SELECT n.*, coalesce(k, 0) AS k FROM n LEFT JOIN (SELECT parent AS node, count(*) AS k FROM kids GROUP BY parent) USING (node)),
sub AS (SELECT DISTINCT a.node, b.node AS below FROM path a JOIN path b ON b.c = a.c AND b.depth >= a.depth),
s AS (SELECT sub.node, count(*) FILTER (k = 0) AS n_leaves, CAST(sum((n - 1) * chars) AS BIGINT) AS saved FROM sub JOIN nk ON nk.node = below GROUP BY sub.node),
e AS (SELECT node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM path JOIN (SELECT c, max(depth) AS depth FROM path GROUP BY c) USING (c, depth) GROUP BY node)
SELECT nk.rep AS conv_id, CAST(nk.depth AS BIGINT) AS depth, up.rep AS parent_conv_id, nk.n AS n_convs, nk.k AS n_children, n_leaves, saved AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nk JOIN s USING (node) LEFT JOIN e USING (node) LEFT JOIN kids ON kids.node = nk.node LEFT JOIN nk up ON up.node = kids.parent""",
}
