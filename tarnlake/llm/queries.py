"""Registered queries of this package, each with the SQL that checks it where SQL can express it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarnlake.llm import chat, codes, langid, lines, mixing, pii, repeats, rules, search, simhash, tiling, toxicity, warc
from tarnlake.llm.common import staged, table


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, written and read back through the index."""
    pages = table(spark, sf_dir, "pages")
    folder, index = warc.write_archives(pages, min_bytes=0)
    kind = pages.schema["page_id"].dataType
    return warc.read_records(folder, index, with_payload=False).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first FROM p)
SELECT page_id, cast(strlen(h) AS bigint) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + cast(((('0x' || substr(x, 1 + 5 * (k // 4), 5))::bigint >> (5 * (3 - k % 4))) & 31) AS int), 1) FOR k IN range(0, 32)], '')
    AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""


def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items: tiles of at least 5 words covering at least 0.8 of an item."""
    docs = table(spark, sf_dir, "documents")
    return tiling.verdicts(docs, tiling.hits(docs, table(spark, sf_dir, "benchmark"), min_match=5, coverage=0.8))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents, learnt from those whose crc32(doc_id) mod 3 is not 1."""
    held_out = F.expr("coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1, false)")
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~held_out).select("doc_id", "text", F.col("lang").alias("label")))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


POLICY = "v1"


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of the quality rules over all documents, with the verdict of policy v1; for documents that one rule alone fails, that
    rule and how many documents would come back without it, as the ablation of the policy tells."""
    policy = rules.POLICIES[POLICY]
    entries = staged(rules.ledger(rules.measure(table(spark, sf_dir, "documents"))), "rule-ledger")
    costs = rules.ablations(entries, policy).select(F.col("rule").alias("lone_rule"), F.col("n_failed_alone").alias("n_alone"))
    bits = F.col("fail_bits").bitwiseAND(F.lit(rules.policy_mask(policy)).cast("long"))
    lone = reduce(lambda rest, rule: F.when(bits == rules.policy_mask([rule]), rule).otherwise(rest), policy, F.lit(""))
    return entries.withColumn("lone_rule", lone).join(costs, "lone_rule", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes(rules.BASE)).alias("base_failed"), rules.passes(policy).alias("kept"),
        "n_lines", "fail_bits", F.lit(POLICY).alias("policy"), "lone_rule", F.coalesce("n_alone", F.lit(0)).cast("long").alias("n_alone"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
l AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w) AS n_words, CASE WHEN len(w) = 0 THEN 0 ELSE list_sum([length(x) FOR x IN w]) END AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n_lines, 0) AS n_lines,
    coalesce(l.n_dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM d LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)),
b AS (
  SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END AS bits
  FROM m)
SELECT doc_id, cast(n_words AS bigint) AS n_words, cast(word_chars AS bigint) AS word_chars, cast(n_symbols AS bigint) AS n_symbols,
  cast(n_dup_lines AS bigint) AS n_dup_lines, cast(n_repeat_words AS bigint) AS n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, bits = 0 AS kept,
  cast(n_lines AS bigint) AS n_lines, cast(bits AS bigint) AS fail_bits, 'v1' AS policy, coalesce(rule, '') AS lone_rule,
  CASE WHEN rule IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY bits) END AS n_alone
FROM b LEFT JOIN (VALUES @RULES@) r(rule, bit) ON bits = bit
""".replace("@RULES@", ", ".join(f"('{rule}', {1 << i})" for i, rule in enumerate(rules.RULES)))


# One large crawl, a few curated sources, the rest plain web.
MIX_DOMAIN = "CASE WHEN source = 'src0' THEN 'crawl' WHEN source IN ('src1', 'src2', 'src3') THEN 'curated' ELSE 'web' END"
MIX_WEIGHTS = {
    ("crawl",): 2, ("curated",): 4, ("web",): 4,
    ("crawl", "en"): 4, ("crawl", "de"): 2, ("web", "en"): 3, ("web", "es"): 2,
    ("curated", "en", "src1"): 3, ("web", "de", "src4"): 5,
}
MIX = {"budget_share": "0.6", "seed": 7, "max_epochs": 2}


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a mix of 60 % of all tokens, with the number of epochs each is in."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, F.expr(MIX_DOMAIN), MIX_WEIGHTS, **MIX).select(
        "doc_id", "domain", "lang", "source", "n_tokens", "copies")


def _weights_sql() -> str:
    rows = [(*path, *[None] * (3 - len(path)), w) for path, w in MIX_WEIGHTS.items()]
    return ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in row) + ")" for row in rows)


def _split_sql(parent: list[str], level: str, depth: int) -> str:
    """The budgets of one level of the tree, from those of the level above."""
    keys, name = ", ".join(parent), f"a{depth}"
    return f"""
n{depth} AS (SELECT {keys}, {level}, sum(capacity) AS capacity, max(CASE WHEN capacity > 0 THEN w{depth} ELSE 0 END)::hugeint AS weight
  FROM leaf GROUP BY ALL),
o{depth} AS (SELECT n{depth}.*, budget, sum(capacity) OVER up AS filled, sum(weight) OVER fam - sum(weight) OVER up AS later
  FROM n{depth} JOIN a{depth - 1} USING ({keys}) WHERE weight > 0
  WINDOW fam AS (PARTITION BY {keys}), up AS (PARTITION BY {keys} ORDER BY capacity::double / weight::double, {level} ROWS UNBOUNDED PRECEDING)),
f{depth} AS (SELECT *, weight * (budget - filled) >= capacity * later AS is_full FROM o{depth}),
{name} AS (SELECT {keys}, {level}, CASE WHEN is_full THEN capacity ELSE
    (budget - coalesce(sum(CASE WHEN is_full THEN capacity END) OVER fam, 0))::hugeint * weight
      // (sum(CASE WHEN NOT is_full THEN weight END) OVER fam)::hugeint END::hugeint AS budget
  FROM f{depth} WINDOW fam AS (PARTITION BY {keys}))"""


OP5_SQL = rf"""
WITH e AS (
  SELECT doc_id, {MIX_DOMAIN} AS domain, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS n_tokens
  FROM documents),
w AS (SELECT * FROM (VALUES {_weights_sql()}) t(d, l, s, w)),
leaf AS (
  SELECT 1 AS root, g.*, coalesce(a.w, 1) AS w1, coalesce(b.w, 1) AS w2, coalesce(c.w, 1) AS w3,
    (tokens * {MIX["max_epochs"]})::hugeint AS capacity
  FROM (SELECT domain, lang, source, sum(n_tokens)::hugeint AS tokens FROM e GROUP BY ALL) g
  LEFT JOIN w a ON a.d = domain AND a.l IS NULL
  LEFT JOIN w b ON b.d = domain AND b.l = lang AND b.s IS NULL
  LEFT JOIN w c ON c.d = domain AND c.l = lang AND c.s = source),
a0 AS (SELECT 1 AS root, least(sum(capacity), sum(tokens)::hugeint * 3 // 5)::hugeint AS budget FROM leaf),
{_split_sql(["root"], "domain", 1)}, {_split_sql(["root", "domain"], "lang", 2)}, {_split_sql(["root", "domain", "lang"], "source", 3)},
p AS (SELECT domain, lang, source, budget // tokens AS f, budget % tokens AS rest
  FROM leaf JOIN a3 USING (domain, lang, source) WHERE budget > 0 AND tokens > 0),
h AS (SELECT e.*, f, rest, ('0x' || substr(md5('{MIX["seed"]}:' || (f + 1)::varchar || ':' || doc_id::varchar), 1, 15))::bigint AS place
  FROM e JOIN p USING (domain, lang, source)),
c AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM h)
SELECT doc_id, domain, lang, source, n_tokens::bigint AS n_tokens, (f + CASE WHEN start < rest THEN 1 ELSE 0 END)::bigint AS copies
FROM c WHERE f > 0 OR start < rest
"""


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of 50 words that a document with a smaller id has too."""
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents"), min_words=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
r AS (SELECT doc_id, i FROM s QUALIFY min(doc_id) OVER (PARTITION BY h) < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM r, (SELECT unnest(range(0, 50)) AS k)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
m AS (SELECT words.*, gone.i IS NOT NULL AS dropped FROM words LEFT JOIN gone USING (doc_id, i)),
k AS (
  SELECT doc_id, cast(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS bigint) AS n,
    string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT dropped) AS t FROM m GROUP BY doc_id)
SELECT d.doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


def op7_pii_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts and digest of the plain spans, and all spans with the disguised ones."""
    base = pii.base_spans(F.col("spans"))
    return pii.detect(table(spark, sf_dir, "documents")).select(
        "doc_id", *(pii.count(base, kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


def op8_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: shingles of 3 words, at most 2 differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=3, max_bits=2)


def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines whose key is in at least 10 documents."""
    kept = lines.drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[ 	-
]+', ''), '[ 	-
]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, cast(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS bigint) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


TOOLS = {
    "search": {"query": ("string", True), "limit": ("integer", False),
               "filter": ({"lang": (["en", "de"], True), "tags": (("array", "string"), False)}, False)},
    "sum": {"terms": ("array", True)},
    "fetch": {"page": ("integer", True)},
}
# Tool messages that the conversations imply, as text that both engines evaluate: an assistant's turn makes a call that needs the
# results of its two calls before, the user's next turn carries the result. Lengths decide tool and faults. In every fifth conversation two
# calls need each other and a third one of them; in every fourth a call comes with the id of the one before.
_TOOL = "CASE n % 4 WHEN 0 THEN 'search' WHEN 1 THEN 'sum' WHEN 2 THEN 'fetch' ELSE 'lookup' END"
_ARGUMENTS = """CASE WHEN n % 13 = 0 THEN concat('{"page": ', n, ',')
  WHEN n % 4 = 0 THEN concat('{"query": "q', n, '", "limit": ', CASE WHEN n % 7 = 0 THEN '"many"' ELSE cast(n % 20 AS varchar(9)) END,
    ', "filter": {"tags": ["t", ', CASE WHEN n % 9 = 0 THEN '5' ELSE '"u"' END, '], "lang": "', CASE WHEN n % 5 = 0 THEN 'xx' ELSE 'de' END, '"} }')
  WHEN n % 4 = 1 THEN concat('{ "terms": [', n, ', 2.5], "b": {"z": null, "a": true}', ' }')
  ELSE concat('{"page":', CASE WHEN n % 11 = 0 THEN 'null' ELSE cast(n AS varchar(9)) END, '}') END"""


def _tool_messages(conversations: DataFrame) -> DataFrame:
    """The messages of the conversations, and the tool messages they imply."""
    sized = conversations.withColumn("n", F.coalesce(F.char_length("text"), F.lit(0)))
    nothing = F.lit(None).cast("string")
    plain = sized.select(
        "conv_id", "turn", "role", "text", nothing.alias("call_id"), nothing.alias("tool"), nothing.alias("arguments"),
        F.array().cast("array<string>").alias("needs"))
    calls = sized.filter("role = 'assistant'").select(
        "conv_id", "turn", F.lit("tool_call").alias("role"), nothing.alias("text"), F.concat(F.lit("call-"), "turn").alias("call_id"),
        F.expr(_TOOL).alias("tool"), F.expr(_ARGUMENTS).alias("arguments"),
        F.array(*(F.concat(F.lit("call-"), (F.col("turn") - back).cast("string")) for back in (2, 4))).alias("needs"))
    loops = sized.filter("turn = 0 AND conv_id % 5 = 2").select(
        "conv_id", "turn", F.lit("tool_call").alias("role"), nothing.alias("text"), F.explode(F.array(*(
            F.struct(F.lit(own).alias("call_id"), F.lit("fetch").alias("tool"), F.lit('{"page":1}').alias("arguments"),
                     F.array(F.lit(need)).alias("needs"))
            for own, need in (("loop-a", "loop-b"), ("loop-b", "loop-a"), ("loop-c", "loop-a"))))).alias("call")).select(
        "conv_id", "turn", "role", "text", "call.*")
    again = sized.filter("role = 'assistant' AND turn >= 3 AND conv_id % 4 = 1").select(
        "conv_id", "turn", F.lit("tool_call").alias("role"), nothing.alias("text"), F.concat(F.lit("call-"), F.col("turn") - 2).alias("call_id"),
        F.lit("fetch").alias("tool"), F.lit('{"page":2}').alias("arguments"), F.array().cast("array<string>").alias("needs"))
    results = sized.filter("role = 'user' AND n % 5 <> 0").select(
        "conv_id", "turn", F.lit("tool_result").alias("role"), F.concat(F.lit("result of "), F.col("n").cast("string")).alias("text"),
        F.concat(F.lit("call-"), (F.col("turn") - 1).cast("string")).alias("call_id"), nothing.alias("tool"),
        nothing.alias("arguments"), F.array().cast("array<string>").alias("needs"))
    return plain.unionAll(calls).unionAll(loops).unionAll(again).unionAll(results)


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations with the tool messages they imply: linked, ordered, validated, as canonical JSON."""
    linked = chat.link(_tool_messages(table(spark, sf_dir, "conversations")), TOOLS)
    return linked.withColumn("errors", F.array_join(F.coalesce("errors", F.array().cast("array<string>")), ";"))


OP10_SQL = f"""
WITH RECURSIVE s AS (SELECT *, coalesce(length(text), 0) AS n FROM conversations),
calls AS (SELECT conv_id, turn, 'call-' || turn AS call_id, {_TOOL} AS tool, {_ARGUMENTS} AS a, n FROM s WHERE role = 'assistant'),
results AS (SELECT conv_id, turn, 'call-' || (turn - 1) AS call_id, 'result of ' || n AS t FROM s WHERE role = 'user' AND n % 5 <> 0),
placed AS (
  SELECT conv_id, turn, turn AS slot, 0 AS level, greatest(turn, coalesce((
    SELECT min(r.turn) FROM results r WHERE r.conv_id = c.conv_id AND r.call_id = c.call_id), turn)) AS until
  FROM calls c WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, greatest(c.turn, p.until), p.level + 1, greatest(c.turn, p.until, coalesce((
    SELECT min(r.turn) FROM results r WHERE r.conv_id = c.conv_id AND r.call_id = c.call_id), c.turn))
  FROM placed p JOIN calls c ON c.conv_id = p.conv_id AND c.turn = p.turn + 2),
checked AS (
  SELECT c.*, CASE WHEN tool = 'lookup' THEN 'unknown tool' WHEN n % 13 = 0 THEN 'no JSON object'
    WHEN tool = 'search' THEN concat_ws(';', CASE WHEN n % 9 = 0 THEN 'type of filter.tags' END,
      CASE WHEN n % 7 = 0 THEN 'type of limit' END, CASE WHEN n % 5 = 0 THEN 'value of filter.lang' END)
    WHEN tool = 'sum' THEN 'unknown field b'
    WHEN tool = 'fetch' AND n % 11 = 0 THEN 'missing page' ELSE '' END AS errors,
    CASE WHEN n % 13 = 0 THEN to_json(a)::varchar ELSE
      CASE n % 4 WHEN 0 THEN '{{"filter":{{"lang":"' || CASE WHEN n % 5 = 0 THEN 'xx' ELSE 'de' END || '","tags":["t",'
        || CASE WHEN n % 9 = 0 THEN '5' ELSE '"u"' END || ']}},"limit":' || CASE WHEN n % 7 = 0 THEN '"many"' ELSE (n % 20)::varchar END || ',"query":"q' || n || '"}}'
      WHEN 1 THEN '{{"b":{{"a":true,"z":null}},"terms":[' || n || ',2.5]}}' ELSE a END END AS canon
  FROM calls c)
SELECT conv_id, turn::bigint AS slot, 0::bigint AS level, turn::bigint AS turn, role, NULL::varchar AS call_id, 'ok' AS status, '' AS errors,
  '{{"role":' || to_json(role)::varchar || coalesce(',"text":' || to_json(text)::varchar, '') || '}}' AS json FROM s
UNION ALL
SELECT c.conv_id, p.slot::bigint, p.level::bigint, c.turn::bigint, 'tool_call', c.call_id,
  CASE WHEN c.errors <> '' THEN 'invalid'
    WHEN NOT EXISTS (SELECT 1 FROM results r WHERE r.conv_id = c.conv_id AND r.call_id = c.call_id) THEN 'no result' ELSE 'ok' END,
  c.errors, '{{"arguments":' || canon || ',"call_id":"' || c.call_id || '","role":"tool_call","tool":"' || tool || '"}}'
FROM checked c JOIN placed p ON p.conv_id = c.conv_id AND p.turn = c.turn
UNION ALL
SELECT conv_id, turn::bigint, 0::bigint, turn::bigint, 'tool_call', id, 'cycle', '',
  '{{"arguments":{{"page":1}},"call_id":"' || id || '","role":"tool_call","tool":"fetch"}}'
FROM s, (VALUES ('loop-a'), ('loop-b'), ('loop-c')) l(id) WHERE turn = 0 AND conv_id % 5 = 2
UNION ALL
SELECT s.conv_id, greatest(s.turn, coalesce(p.slot, s.turn))::bigint, coalesce(p.level, 0)::bigint, s.turn::bigint, 'tool_call', 'call-' || (s.turn - 2),
  CASE WHEN p.turn IS NULL THEN 'no result' ELSE 'duplicate id' END, '',
  '{{"arguments":{{"page":2}},"call_id":"call-' || (s.turn - 2) || '","role":"tool_call","tool":"fetch"}}'
FROM s LEFT JOIN placed p ON p.conv_id = s.conv_id AND p.turn = s.turn - 2 WHERE s.role = 'assistant' AND s.turn >= 3 AND s.conv_id % 4 = 1
UNION ALL
SELECT r.conv_id, greatest(r.turn, coalesce(p.slot, r.turn))::bigint, coalesce(p.level, 0)::bigint, r.turn::bigint, 'tool_result', r.call_id,
  CASE WHEN p.turn IS NULL THEN 'no call' ELSE 'ok' END, '',
  '{{"call_id":"' || r.call_id || '","role":"tool_result","text":"' || t || '"}}'
FROM results r LEFT JOIN placed p ON p.conv_id = r.conv_id AND p.turn = r.turn - 1
"""


def op11_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


_TERMS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
OP11_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
s AS (SELECT count(*)::bigint AS n_docs, sum(len(w))::bigint AS length FROM d WHERE len(w) > 0),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w)::bigint AS n, unnest(w) AS term FROM d) GROUP BY ALL),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
x AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::bigint AS weight
  FROM p, s WHERE term IN (SELECT term FROM q) GROUP BY term),
r AS (
  SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // length))))::bigint AS score
  FROM q JOIN x USING (term) JOIN p USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::int AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 50
"""


def op12_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labels of those whose crc32(doc_id) mod 5 is not 0."""
    held_out = F.expr("coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, false)")
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("toxic").alias("label"))
    languages = langid.train(docs.filter(~held_out).select("doc_id", "text", F.col("lang").alias("label")), per_label=toxicity.LANGUAGE_SAMPLE)
    return toxicity.score(docs, toxicity.train(docs, labels, languages)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op13_active_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings: 4 parts, 256 entries each, 4 rounds."""
    state, books = codes.encode(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)
    return codes.codes(state, books).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256", "label")


def _op13_sql(rounds: int = 4) -> str:
    """Plain Lloyd rounds: every part against every entry each time."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, label, part, v, arg_min(entry, (far, entry)) AS entry, min(far)::bigint AS far
  FROM (SELECT p.vec_id, p.label, p.part, p.v, c.entry,
      list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, c.v) + list_inner_product(c.v, c.v) AS far
    FROM p JOIN c{r} c USING (part)) GROUP BY vec_id, label, part, v)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(u.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT part, entry, list(floor_mean ORDER BY i)::double[] AS v FROM (
      SELECT part, entry, i, (total - ((total % n) + n) % n) // n AS floor_mean FROM (
        SELECT part, entry, i, sum(v[i]::bigint)::bigint AS total, count(*) AS n
        FROM (SELECT part, entry, v, unnest(range(1, len(v) + 1)) AS i FROM a{r}) GROUP BY part, entry, i))
    GROUP BY part, entry) u USING (part, entry))""")
    last = f"c{rounds}"
    return f"""
WITH k AS (
  SELECT vec_id, label, [floor(1024 * x)::bigint FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (
  SELECT vec_id, label, part, q[part * (len(q) // 4) + 1:(part + 1) * (len(q) // 4)]::double[] AS v
  FROM k, (SELECT unnest(range(4)) AS part)),
c0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v
  FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 256)),
{", ".join(steps)},
h AS (SELECT sha256(string_agg(x, ',' ORDER BY part, entry)) AS codebooks_sha256
  FROM (SELECT part, entry, array_to_string([x::bigint FOR x IN v], ',') AS x FROM {last})),
e AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::bigint AS error
  FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::bigint AS label_error, codebooks_sha256, label FROM e, h
"""


QUERIES = {
    "op1_warc_index": op1_warc_index,
    "op2_string_tiling": op2_string_tiling,
    "op3_language_id": op3_language_id,
    "op4_quality_rules": op4_quality_rules,
    "op5_mix_sources": op5_mix_sources,
    "op6_repeated_passages": op6_repeated_passages,
    "op7_pii_offsets": op7_pii_offsets,
    "op8_simhash_golay": op8_simhash_golay,
    "op9_line_runs": op9_line_runs,
    "op10_tool_calls": op10_tool_calls,
    "op11_mask_search": op11_mask_search,
    "op12_toxicity_cnn": op12_toxicity_cnn,
    "op13_active_codes": op13_active_codes,
}
ORACLE = {
    "op1_warc_index": OP1_SQL,
    "op4_quality_rules": OP4_SQL,
    "op5_mix_sources": OP5_SQL,
    "op6_repeated_passages": OP6_SQL,
    "op9_line_runs": OP9_SQL,
    "op10_tool_calls": OP10_SQL,
    "op11_mask_search": OP11_SQL,
    "op13_active_codes": _op13_sql(),
}
