"""One query per operator over its whole table; SQL where it can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from fieldprep.llm import bpe, chat_format, exact_dedup, language, mixing, quality_rules, repeats, secrets, simhash, spelling, toxicity, vectors, whitening
from fieldprep.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401


@query(
    r"""
    WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
         g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
    """
)
def op10_exact_dedup(spark, d):
    """Exact copies by a minimal perfect hash over the digests of the first half, the rest arriving."""
    found = exact_dedup.exact_dedup(table(spark, d, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op5_simhash_near_dedup(spark, d):
    """SimHash fingerprints of four-word shingles, linked at four differing bits or fewer."""
    return simhash.near_duplicates(table(spark, d, "documents")).drop("component")


@query()
def op6_toxicity(spark, d):
    """Toxicity of every text by a model of the labelled documents that are not held out."""
    docs = table(spark, d, "documents")
    return toxicity.score(docs, toxicity.fit_on(docs, table(spark, d, "labels")))


@query()
def op3_language_id(spark, d):
    """The language of every text by a model of the documents that are not held out."""
    docs = table(spark, d, "documents")
    return language.identify(docs, language.fit_on(docs))


@query()
def op4_bpe(spark, d):
    """Byte-level BPE ids of every text and the text they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.round_trip(table(spark, d, "documents"), path)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")


@query(
    r"""
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
         w AS (SELECT *, CASE WHEN size = 0 THEN 0.5::DOUBLE WHEN length(t) BETWEEN 4 * size AND 12 * size THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
                      (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM d),
         k AS (SELECT *, 1.0::DOUBLE - pow(u, 1.0::DOUBLE / weight) AS key FROM w),
         s AS (SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS most FROM k GROUP BY source),
         r AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS sw FROM s),
         o AS (SELECT *, sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / sw, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                      sum(sw) OVER (ORDER BY most / sw, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS among FROM r),
         b AS (SELECT rest::DOUBLE AS rest, among::DOUBLE AS among FROM o ORDER BY rest / among DESC LIMIT 1),
         t AS (SELECT source, source_size, least(most::DOUBLE, b.rest * sw / b.among) AS target FROM r, b),
         e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
         c AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
                      sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS LAST) AS upto
               FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
    SELECT doc_id, size::BIGINT AS size, source_size, target, (size * (epochs + (upto - size / 2 <= rest)::INT))::BIGINT AS taken FROM c
    """
)
def op7_source_mixing(spark, d):
    """Whole documents in weighted random order, to the target of each source."""
    return mixing.mix(table(spark, d, "documents"))


@query(
    r"""
    WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
         a AS (SELECT doc_id, lang, text, words, len(words) AS n_words, length(text) AS n_chars, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                      length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w),
         g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS t FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
         r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
               FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS n FROM g) WHERE n > 1) GROUP BY doc_id),
         c AS (SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS k
               FROM (SELECT lang, lower(word) AS word, count(*) AS n FROM (SELECT lang, unnest(words) AS word FROM w WHERE lang IS NOT NULL) GROUP BY ALL) QUALIFY k <= 12),
         h AS (SELECT doc_id, k, count(*) AS n FROM (SELECT doc_id, lang, lower(unnest(words)) AS word FROM w) JOIN c USING (lang, word) GROUP BY ALL),
         bw AS (SELECT a.doc_id, a.lang, c.k, coalesce(h.n, 0) AS n FROM a JOIN c USING (lang) LEFT JOIN h ON h.doc_id = a.doc_id AND h.k = c.k
                UNION ALL SELECT a.doc_id, a.lang, 0, a.n_words - coalesce((SELECT sum(n) FROM h WHERE h.doc_id = a.doc_id), 0) FROM a WHERE a.lang IS NOT NULL),
         bc AS (SELECT doc_id, lang, unnest(range(0, 7)) AS k,
                       unnest([length(regexp_replace(text, '[^a-z]+', '', 'g')), length(regexp_replace(text, '[^A-Z]+', '', 'g')), length(regexp_replace(text, '[^0-9]+', '', 'g')),
                               n_symbols, length(regexp_replace(text, '[\x00-\x7F]+', '', 'g')), n_chars - word_chars,
                               length(regexp_replace(text, '[a-zA-Z0-9#*$%&|<>\x20\x09-\x0D]+|[^\x00-\x7F]+', '', 'g'))]) AS n FROM a WHERE lang IS NOT NULL),
         l AS (SELECT lang FROM a GROUP BY lang HAVING sum(n_words) >= 2000),
         js AS (SELECT kind, doc_id, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS far
                FROM (SELECT kind, doc_id, n / sum(n) OVER (PARTITION BY kind, doc_id) AS p, rn / sum(rn) OVER (PARTITION BY kind, doc_id) AS q
                      FROM (SELECT *, sum(n) OVER (PARTITION BY kind, lang, k) AS rn
                            FROM (SELECT 'w' AS kind, * FROM bw UNION ALL SELECT 'c' AS kind, * FROM bc) WHERE lang IN (SELECT lang FROM l)))
                GROUP BY kind, doc_id),
         f AS (SELECT a.*, coalesce(r.n_repeat_words, 0) AS n_repeat_words, n_words < 50 OR 100 * coalesce(r.n_repeat_words, 0) > 50 * n_words AS base_failed FROM a LEFT JOIN r USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND coalesce(n_chars < 200 OR jc.far <= 0.32, true) AND coalesce(n_words < 100 OR jw.far <= 0.4, true) AS kept
    FROM f LEFT JOIN (SELECT doc_id, far FROM js WHERE kind = 'c') jc USING (doc_id) LEFT JOIN (SELECT doc_id, far FROM js WHERE kind = 'w') jw USING (doc_id)
    """
)
def op9_quality_rules(spark, d):
    """Surface counts, base rules and divergence from the language of every text."""
    return quality_rules.judged(table(spark, d, "documents")).drop("far_chars", "far_words")


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark, d):
    """Documents to token ids through all stages."""
    return corpus_pipeline.run(spark, d)


@query(
    r"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
         e AS (SELECT *, replace(replace(replace(replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '<s>', '<\s>'), '</s>', '<\/s>') AS shown,
                      len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS size FROM c),
         p AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - size AS before FROM e),
         w AS (SELECT *, before // 512 AS win, length(role) + length(shown) + 23 AS chars, before = 0 AND role = 'system' AS opens FROM p),
         own AS (SELECT conv_id, win, sum(chars) AS chars FROM w GROUP BY ALL),
         past AS (SELECT conv_id, win + 1 AS win, sum(chars) AS chars FROM w WHERE NOT opens AND before >= (win + 1) * 512 - 128 GROUP BY ALL),
         sys AS (SELECT conv_id, chars FROM w WHERE opens),
         f AS (SELECT own.conv_id, sum(own.chars + coalesce(past.chars, 0) + CASE WHEN own.win > 0 THEN coalesce(sys.chars, 0) ELSE 0 END) AS formatted_chars
               FROM own LEFT JOIN past USING (conv_id, win) LEFT JOIN sys USING (conv_id) GROUP BY ALL),
         t AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
                      coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS loss_chars,
                      sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256 FROM c GROUP BY conv_id)
    SELECT conv_id, n_turns, turns_sha256, loss_chars::BIGINT AS loss_chars, loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM t JOIN f USING (conv_id)
    """
)
def op8_chat_format(spark, d):
    """Windows of all conversations, and of one that speaks in control strings, read back."""
    conversations = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat_format.summaries(chat_format.windows(conversations.unionByName(own)))


@query()
def op2_secret_scan(spark, d):
    """Secrets by patterns, and by automata inferred from what these found."""
    docs = table(spark, d, "documents")
    found = secrets.find(docs, secrets.fit_on(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_format")


@query()
def op1_suffix_dedup(spark, d):
    """What stays of every text without the bytes of strings of 400 bytes that start elsewhere too."""
    return repeats.repeated_bytes(table(spark, d, "documents")).drop("spans")


@query()
def op13_whitening(spark, d):
    """Embeddings along the four leading components of their covariance, each scaled to unit variance."""
    return whitening.whiten(table(spark, d, "embeddings"))


@query(
    r"""
    WITH RECURSIVE bits AS (SELECT i, 0 AS k, i::BIGINT AS c FROM (SELECT unnest(range(256)) AS i)
                            UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
         crc AS (SELECT list(c ORDER BY i) AS steps FROM bits WHERE k = 8),
         runs AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
         once AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
         bytes AS (SELECT *, hex(encode(id || run)) AS x FROM once),
         hashed AS (SELECT run, n, xor(list_reduce(list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
                           lambda a, b: xor(a >> 8, steps[xor(a, b) % 256 + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h FROM bytes, crc),
         words AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
         v AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
         gaps AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
         near AS (SELECT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b USING (i, rest) WHERE a.word <> b.word
                  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN v b ON a.rest = b.word
                  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN v b ON a.rest = b.word),
         best AS (SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
         lead AS (SELECT word, n_near, most, min(other) AS other FROM best JOIN near USING (word) WHERE near.n = most GROUP BY ALL),
         f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * v.n THEN other END AS form, CASE WHEN most >= 10 * v.n THEN most END AS form_n FROM v LEFT JOIN lead USING (word)),
         chain AS (SELECT word, word AS at, form FROM f UNION ALL SELECT chain.word, f.word, f.form FROM chain JOIN f ON chain.form = f.word)
    SELECT f.word, f.form, chain.at AS root, f.n, f.n_near, f.form_n FROM f JOIN chain USING (word) WHERE chain.form IS NULL
    """
)
def op12_spelling_variants(spark, d):
    """Words one edit apart, each with its more frequent form and the end of the chain of forms."""
    return spelling.variants(table(spark, d, "documents"))


@query(
    """
    WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
         ok AS (SELECT * FROM e WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(v, lambda c: c <> 0)) > 0),
         links AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r WHERE list_cosine_similarity(a.v, b.v) >= 0.93::DOUBLE),
         reach AS (SELECT r AS a, r AS b FROM e UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
         least AS (SELECT reach.a AS r, min(e.vec_id) AS component_id FROM reach JOIN e ON e.r = reach.b GROUP BY ALL),
         many AS (SELECT a AS r, count(*) AS n FROM links GROUP BY ALL)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM e JOIN least USING (r) LEFT JOIN many USING (r)
    """
)
def op11_embedding_near_dedup(spark, d):
    """Embeddings of one label linked by cosine, found in small-world graphs of all shards."""
    return vectors.near_vectors(table(spark, d, "embeddings"))
