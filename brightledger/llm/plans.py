"""The registered queries of this subpackage over the supplied tables, and their SQL where SQL can state them."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, decontam, embeddings, licenses, lines, minhash, pii, quality, secrets, spelling, tokens, turns, urls
from .common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

#: By definition: all pairs that share a shingle, exact shares, and the closure of their links.
NEAR_DOCUMENTS = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle FROM w, unnest(range(1, greatest(2, len(words) - 3))) u(i) WHERE len(words) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
    k AS (SELECT doc_id, n, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS same FROM s JOIN n USING (doc_id) GROUP BY ALL),
    r AS (SELECT same, n, min(doc_id) AS rep FROM k GROUP BY ALL),
    rs AS (SELECT s.* FROM s JOIN r ON doc_id = rep),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM rs a JOIN rs b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * common >= 85 * (x.n + y.n - common)),
    reach(a, b) AS (SELECT rep, rep FROM r UNION SELECT reach.a, step.b FROM reach JOIN (SELECT a, b FROM e UNION ALL SELECT b, a FROM e) step ON reach.b = step.a),
    c AS (SELECT a AS rep, min(b) AS component FROM reach GROUP BY ALL)
    SELECT doc_id, coalesce(k.n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id, doc_id = coalesce(component, doc_id) AS kept
    FROM documents LEFT JOIN k USING (doc_id) LEFT JOIN r USING (same) LEFT JOIN c USING (rep)"""

#: By definition: all pairs of vectors, and the closure of their links.
NEAR_VECTORS = r"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
    ok AS (SELECT * FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(x, lambda y: y <> 0)) > 0),
    link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
    reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
    c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY ALL), d AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY ALL)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c USING (vec_id) LEFT JOIN d USING (vec_id)"""


#: The sites the page filter blocks and allows, and patterns of hosts that exist for links alone.
SITES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
LINK_HOSTS = ["*spam-farm.**", "*cheap-pills.**", "*casino-*.**", "*.link-exchange.**"]

#: By definition: the longest site whose host the URL's host is or ends with, then patterns of hosts.
PAGE_VERDICTS = r"""WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
    f AS (SELECT *, CASE WHEN suffix('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                         WHEN suffix('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                         WHEN suffix('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                         WHEN suffix('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
                    CASE WHEN contains(host, 'spam-farm.') THEN '*spam-farm.**' WHEN contains(host, 'cheap-pills.') THEN '*cheap-pills.**'
                         WHEN regexp_matches(host, 'casino-.*\.', 's') THEN '*casino-*.**' WHEN contains(host, '.link-exchange.') THEN '*.link-exchange.**' END AS hosts FROM p)
    SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN hosts END AS glob,
           CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN hosts IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict FROM f"""


#: The table of the checksum that crc32 uses, and the checksum of column k.
CRC_TABLE = "crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT)) AS tab)"
CRC = ("xor(list_reduce(list_transform(range(length(hex(encode(k))) // 2), lambda i: ('0x' || substr(hex(encode(k)), 2 * i + 1, 2))::BIGINT), "
       "lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295)")

#: By definition: faults row by row, then the least (cost, audit) for each grammar state, from each conversation's last row to its first.
REPAIRS = rf"""WITH RECURSIVE {CRC_TABLE},
    k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
    d AS (SELECT conv_id, turn, role, text, {CRC} % 20 AS d FROM k, crc),
    r AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE WHEN d = 1 THEN '' WHEN d = 2 THEN translate(text, '.!?', '') ELSE text END AS text FROM d, unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) WHERE d <> 0),
    o AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t, left(role, 1) AS initial,
              row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || ':' || text)) AS i FROM r),
    f AS (SELECT *, CASE WHEN t = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS odd FROM o),
    e AS (SELECT conv_id, i, initial, coalesce(fault IN ('blank', 'duplicate'), false) AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS late FROM f),
    n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
              count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (odd) AS illegal FROM f GROUP BY ALL),
    v AS (SELECT conv_id, n + 1 AS i, {{c: 0, a: ''}} AS none, {{c: 10, a: 'II'}} AS sys, {{c: 5, a: 'I'}} AS usr, {{c: 0, a: ''}} AS ast FROM n
          UNION ALL SELECT conv_id, i, list_min([s.none, {{c: s.usr.c + 5, a: 'I' || s.usr.a}}, {{c: s.ast.c + 10, a: 'II' || s.ast.a}}]), list_min([s.sys, {{c: s.usr.c + 5, a: 'I' || s.usr.a}}, {{c: s.ast.c + 10, a: 'II' || s.ast.a}}]),
                           list_min([s.usr, {{c: s.ast.c + 5, a: 'I' || s.ast.a}}]), list_min([s.ast, {{c: s.usr.c + 5, a: 'I' || s.usr.a}}])
          FROM (SELECT e.conv_id, e.i, {{
              none: list_min([{{c: none.c + 2, a: 'D' || none.a}}, CASE WHEN NOT gone AND initial = 's' THEN {{c: sys.c + late, a: 'K' || sys.a}} END, CASE WHEN NOT gone THEN {{c: usr.c + late + (initial <> 'u')::INT, a: CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END || usr.a}} END]),
              sys: list_min([{{c: sys.c + 2, a: 'D' || sys.a}}, CASE WHEN NOT gone THEN {{c: usr.c + late + (initial <> 'u')::INT, a: CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END || usr.a}} END]),
              usr: list_min([{{c: usr.c + 2, a: 'D' || usr.a}}, CASE WHEN NOT gone THEN {{c: ast.c + late + (initial <> 'a')::INT, a: CASE WHEN initial = 'a' THEN 'K' ELSE 'R' END || ast.a}} END]),
              ast: list_min([{{c: ast.c + 2, a: 'D' || ast.a}}, CASE WHEN NOT gone THEN {{c: usr.c + late + (initial <> 'u')::INT, a: CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END || usr.a}} END])}} AS s
              FROM v JOIN e ON e.conv_id IS NOT DISTINCT FROM v.conv_id AND e.i = v.i - 1)),
    a AS (SELECT conv_id, none.c::BIGINT AS cost, none.a AS audit FROM v WHERE i = 1),
    x AS (SELECT conv_id, j, substr(audit, j, 1) AS edit, length(replace(left(audit, j), 'I', '')) AS i, length(replace(left(audit, j), 'D', '')) AS p FROM a, unnest(range(1, length(audit) + 1)) u(j)),
    y AS (SELECT x.*, f.role, f.text, bool_or(p = 1 AND edit = 'K' AND initial = 's') OVER (PARTITION BY x.conv_id) AS led FROM x LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM x.conv_id AND f.i = x.i WHERE edit <> 'D'),
    z AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (p - led::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j)) AS h FROM y GROUP BY ALL)
    SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
           coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id"""


#: By definition: words one edit apart share the word that is left without one letter, and the forms are followed one by one.
VARIANTS = rf"""WITH RECURSIVE {CRC_TABLE},
    t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
    k AS (SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS k, count(*) AS m FROM t WHERE length(run) >= 6 GROUP BY ALL),
    h AS (SELECT run, m, {CRC} AS h FROM k, crc),
    w AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, m FROM h),
    v AS (SELECT word, sum(m)::BIGINT AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
    d AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS less FROM v, unnest(range(1, length(word) + 1)) u(i)),
    p AS (SELECT a.word, b.word AS near, b.n FROM d a JOIN d b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
          UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.less = v.word UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.less = v.word),
    c AS (SELECT word, count(*) AS n_near, arg_min(near, {{n: -n, w: near}}) AS near, max(n) AS near_n FROM p GROUP BY ALL),
    f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form, CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n FROM v LEFT JOIN c USING (word)),
    r(word, root) AS (SELECT word, word FROM f WHERE form IS NULL UNION ALL SELECT f.word, r.root FROM f JOIN r ON f.form = r.word)
    SELECT word, form, root, n, n_near, form_n FROM f JOIN r USING (word)"""


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def stated(sql: str):
    """Register a query with the DuckDB statement it must equal."""

    def add(fn):
        ORACLE[fn.__name__] = sql
        return query(fn)

    return add


@stated(NEAR_DOCUMENTS)
def op1_minhash_near_dedup(spark, sf_dir):
    """Near-duplicate components of all documents at 85 in 100 shared shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query
def op2_line_dedup(spark, sf_dir):
    """Every document without later repeated runs of lines."""
    out = lines.drop_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "words_before", "words_after")


@query
def op3_byte_bpe(spark, sf_dir):
    """Encode every document and decode the ids again."""
    coded = bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


@query
def op4_quality_classifier(spark, sf_dir):
    """Every document's evidence, site posteriors and decision."""
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


@query
def op5_benchmark_decontamination(spark, sf_dir):
    """Every document that holds a benchmark item, possibly with other numbers, units or names."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_secret_scan(spark, sf_dir):
    """Secrets in every document: fixed patterns and what the randomness tests add."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    counts = [secrets.count("base", i).alias(f"n_{k}") for i, k in enumerate(secrets.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(secrets.listing("base", secrets.KINDS), 256).alias("base_sha256"), secrets.listing("spans", secrets.KINDS).alias("spans"))


@query
def op7_pii(spark, sf_dir):
    """Personal data in every document: fixed patterns and what the weakly supervised classifier adds."""
    found = pii.scan(table(spark, sf_dir, "documents"))
    counts = [secrets.count("base", i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(secrets.listing("base", pii.KINDS), 256).alias("base_sha256"), secrets.listing("spans", pii.KINDS).alias("spans"))


@stated(NEAR_VECTORS)
def op8_embedding_near_dedup(spark, sf_dir):
    """Links and components of all embeddings at a cosine of 0.95."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op9_token_counts(spark, sf_dir):
    """Token counts of every document, and whether it exceeds a context of 2048 tokens."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


@query
def op10_license_scan(spark, sf_dir):
    """License notices in every document, with the places and the share of the notice found."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string")))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join(spans, ",").alias("spans"), F.round(F.array_min(F.transform("matches", lambda m: m["share"])), 6).alias("least_share"))


@stated(PAGE_VERDICTS)
def op12_url_filter(spark, sf_dir):
    """Every page's host, path and verdict, with the site rule or pattern that decides."""
    rules = urls.by_length(SITES) + [urls.Rule("block", glob) for glob in LINK_HOSTS]
    found = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return found.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNull(), F.col("glob")).alias("glob"), "verdict")


def dropped_letter(doc_id: str, run: str) -> str:
    """One run in 199 loses a letter, so that there are misspellings to be found."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]


@stated(VARIANTS)
def op11_spelling_variants(spark, sf_dir):
    """Every word of the documents with its near words, most frequent form and root."""
    return spelling.variants(spelling.count_words(table(spark, sf_dir, "documents"), change=dropped_letter))


def damaged(rows):
    """Rows of conversations with the faults that the repair is tried on; a null counts as one space."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    role, text = F.when(kind == 4, "user").otherwise(role), F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), F.lit(2))).alias("copy"), times.alias("times")).where("copy <= times").drop("copy", "times")


@stated(REPAIRS)
def op13_conversation_repair(spark, sf_dir):
    """Faults of every damaged conversation, and its cheapest repair."""
    rows = table(spark, sf_dir, "conversations")
    found = turns.repair(damaged(rows))
    hashes = turns.digests(found.rows).withColumnRenamed("conv_id", "c")
    fixed = found.conversations.join(hashes, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c").withColumnRenamed("conv_id", "c")
    counts = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    out = rows.select("conv_id").distinct().join(fixed, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def load():
    """(queries, SQL) with the pipeline, which stands at the repository's top."""
    import corpus_pipeline

    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
    return QUERIES, ORACLE
