"""The registered queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.byte_bpe import encode_documents
from tickloom.llm.conversations import audit_conversations
from tickloom.llm.divergence import source_divergence
from tickloom.llm.host_rules import judge_documents
from tickloom.llm.hyperminhash import near_duplicates
from tickloom.llm.lang_id import identify
from tickloom.llm.maxent_lm import score_documents
from tickloom.llm.mixing import mix_sources
from tickloom.llm.quality import judge_quality
from tickloom.llm.sharding import byte_shards
from tickloom.llm.suffix_dedup import remove_repeats
from tickloom.llm.token_orc import read_tokens, token_index, tokens_path, write_tokens
from tickloom.llm.topk_fagin import top_k
from tickloom.session import table


def op1_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op2_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        keep_ids=False,
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed so that a source's share follows the square root of its size."""
    return mix_sources(table(spark, sf_dir, "documents"), power=0.5).select(
        "doc_id", "source", "lang", "text", "copy_no", "mix_key"
    )


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the vectors whose id is divisible by 100; all vectors are candidates."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's host is its source."""
    judged = judge_documents(table(spark, sf_dir, "documents"), F.col("source"))
    return judged.withColumn("host_rate", F.round("host_rate", 6))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(table(spark, sf_dir, "documents"), 24)


def op9_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), n_words=2, percent=80)


def op10_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = tokens_path(docs)
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_index(read_tokens(spark, path))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged first by the hashes of their rows."""
    return audit_conversations(table(spark, sf_dir, "conversations"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: the model is learned; tests hold scores against brute force and held-out labels."""
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_maxent_lm": op1_maxent_lm,
    "op2_lang_id": op2_lang_id,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_mixing": op5_mixing,
    "op6_topk": op6_topk,
    "op7_host_rules": op7_host_rules,
    "op8_sharding": op8_sharding,
    "op9_hyperminhash": op9_hyperminhash,
    "op10_token_orc": op10_token_orc,
    "op11_repair": op11_repair,
    "op12_divergence": op12_divergence,
    "op13_quality": op13_quality,
}

ORACLE_SQL: dict[str, str] = {
    "op3_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
        w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM d, unnest(range(0, n - 49)) AS r(p) WHERE n >= 50),
        f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
        hit AS (SELECT w.doc_id, p FROM w JOIN f USING (s) WHERE first < w.doc_id),
        starts AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM hit),
        runs AS (SELECT *, sum((before IS NULL OR p > before + 50)::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM starts),
        spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY ALL),
        kept AS (
            SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
            UNION ALL SELECT d.doc_id, coalesce(max(b), 0), any_value(n) FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id
        ),
        rest AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM kept JOIN d USING (doc_id) GROUP BY 1),
        sums AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY 1)
        SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(rest.h)) AS kept_sha256
        FROM d LEFT JOIN sums USING (doc_id) JOIN rest USING (doc_id)
    """,
    "op7_host_rules": r"""
        WITH t AS (
            SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents
        ),
        v AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM t, unnest(range(1, len(w) - 3)) AS r(i)),
        again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) > 1 AS often FROM v),
        covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(0, 5) AS r(k) WHERE often GROUP BY 1),
        c AS (
            SELECT t.doc_id, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                coalesce(covered.n, 0) AS n_repeat_words FROM t LEFT JOIN covered USING (doc_id)
        ),
        j AS (
            SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, base_failed OR 10 * n_symbols > n_words
                OR word_chars < 3 * n_words OR word_chars > 12 * n_words OR 5 * n_dup_lines > n_words AS any_failed FROM c
        ),
        h AS (SELECT source, count(*) AS n, count_if(any_failed) AS failed FROM j GROUP BY 1),
        s AS (
            SELECT count(*) AS k, sum(n) AS n, sum(failed) / sum(n) AS m, sum(failed * failed / n) - sum(n) * (sum(failed) / sum(n)) ** 2 AS between,
                sum(n) - sum(n * n) / sum(n) AS spread FROM h
        ),
        e AS (SELECT *, m * (1 - m) AS chance, CASE WHEN k > 1 AND spread > 0 THEN (between - (k - 1) * m * (1 - m)) / spread ELSE 0 END AS extra FROM s),
        p AS (SELECT m, CASE WHEN extra > 0 AND chance > extra THEN chance / extra - 1 ELSE n / k END AS strength FROM e),
        r AS (SELECT source, (failed + m * strength) / (n + strength) AS rate, least(0.5, 2 * m) AS most FROM h, p)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rate <= most AS kept, j.source AS host,
            round(rate, 6) AS host_rate FROM j JOIN r ON j.source IS NOT DISTINCT FROM r.source
    """,
    "op8_sharding": """
        WITH crcs AS (
            SELECT list(list_reduce(range(0, 8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)::BIGINT ORDER BY b) AS t
            FROM range(0, 256) AS r(b)
        ),
        d AS (SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
        c AS (
            SELECT doc_id, size, xor(4294967295, list_reduce(
                list_transform(range(0, size - 8), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
                lambda a, x: xor(a >> 8, t[1 + xor(a & 255, x)]), 4294967295::BIGINT)) AS text_crc32
            FROM d, crcs
        ),
        p AS (SELECT *, sum(size) OVER (ORDER BY doc_id) AS upto, sum(size) OVER () AS whole FROM c),
        s AS (SELECT *, least(23, (2 * upto - size) * 24 // (2 * whole))::INT AS shard FROM p)
        SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INT AS grown_shard FROM s
    """,
    "op9_hyperminhash": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ),
        s AS (
            SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
            FROM w, unnest(range(1, greatest(len(w), least(len(w), 1) + 1))) AS r(i) WHERE len(w) > 0
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(id, other) AS (SELECT a, b FROM edges UNION SELECT reach.id, edges.b FROM reach JOIN edges ON edges.a = reach.other),
        least_of AS (SELECT id, min(other) AS least FROM reach GROUP BY 1)
        SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id, least(doc_id, coalesce(least, doc_id)) = doc_id AS kept
        FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON id = doc_id
    """,
    "op6_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 100 = 0
        ),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op5_mixing": """
        WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        rates AS (
            SELECT source, sqrt(n) / sum(sqrt(n)) OVER () * sum(n) OVER () / n AS rate FROM counts
        ),
        pieces AS (
            SELECT source, rate, greatest(1, ceil(rate / 16))::INT AS pieces, rate / greatest(1, ceil(rate / 16)) AS m
            FROM rates
        ),
        cdf AS (
            SELECT source, pieces, k, sum(exp(-m) * pow(m, k) / gamma(k + 1)) OVER (
                PARTITION BY source ORDER BY k) AS upto
            FROM pieces, range(0, 120) AS r(k)
        ),
        lists AS (SELECT source, pieces, list(upto ORDER BY k) AS cdf FROM cdf GROUP BY source, pieces),
        drawn AS (
            SELECT d.doc_id, l.source, d.lang, d.text,
                list_sum(list_transform(range(0, l.pieces), lambda i: len(list_filter(l.cdf, lambda c: c <=
                    ('0x' || substr(md5('17:n|' || d.doc_id || '|' || i), 1, 13))::BIGINT / 4503599627370496.0))))::INT AS n
            FROM documents d JOIN lists l ON d.source IS NOT DISTINCT FROM l.source
        ),
        copies AS (SELECT *, unnest(range(1, n + 1))::INT AS copy_no FROM drawn WHERE n > 0)
        SELECT doc_id, source, lang, text, copy_no,
            ('0x' || substr(md5('17:k|' || doc_id || '|' || copy_no), 1, 15))::BIGINT AS mix_key
        FROM copies
    """,
    "op11_repair": r"""
        WITH RECURSIVE crcs AS (
            SELECT list(list_reduce(range(0, 8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)::BIGINT ORDER BY b) AS t
            FROM range(0, 256) AS r(b)
        ),
        given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
        hashed AS (
            SELECT given.*, xor(4294967295, list_reduce(list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1))::BIGINT),
                lambda a, x: xor(a >> 8, t[1 + xor(a & 255, x)]), 4294967295::BIGINT)) % 20 AS h FROM given, crcs
        ),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
                CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM hashed, range(0, CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS r(copy)
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again, left(role, 1) AS initial
            FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)
        ),
        rows AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN again > 1 THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
                lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM placed
        ),
        stats AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'b') AS blank,
                count_if(fault = 'd') AS duplicate, count_if(fault = 't') AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY 1
        ),
        back AS (
            SELECT conv_id, n AS i, 0 AS c0, 4 AS c1, 2 AS c2, 0 AS c3 FROM stats
            UNION ALL
            SELECT conv_id, i, least(d0, 2 + least(d2, 2 + d3)), least(d1, 2 + least(d2, 2 + d3)), least(d2, 2 + d3), least(d3, 2 + d2) FROM (
                SELECT b.conv_id, b.i - 1 AS i,
                    least(3 + c0, stay + least(CASE initial WHEN 's' THEN c1 WHEN 'u' THEN c2 ELSE 9999 END, 2 + c2)) AS d0,
                    least(3 + c1, stay + least(CASE WHEN initial = 'u' THEN c2 ELSE 9999 END, 2 + c2)) AS d1,
                    least(3 + c2, stay + least(CASE WHEN initial = 'a' THEN c3 ELSE 9999 END, 2 + c3)) AS d2,
                    least(3 + c3, stay + least(CASE WHEN initial = 'u' THEN c2 ELSE 9999 END, 2 + c2)) AS d3
                FROM back b JOIN (SELECT *, CASE fault WHEN 'b' THEN 9999 WHEN 'd' THEN 9999 WHEN 't' THEN 1 ELSE 0 END AS stay FROM rows) r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i
            )
        ),
        costs AS (SELECT conv_id, i, [c0, c1, c2, c3] AS c FROM back),
        walk AS (
            SELECT conv_id, 0::BIGINT AS i, 1 AS s, '' AS audit, []::VARCHAR[] AS kept FROM stats
            UNION ALL
            SELECT conv_id, CASE WHEN edit = 'I' THEN i ELSE i + 1 END, CASE edit WHEN 'D' THEN s WHEN 'K' THEN k ELSE m END, audit || edit,
                CASE edit WHEN 'D' THEN kept WHEN 'K' THEN list_append(kept, role || ':' || text)
                    ELSE list_append(kept, CASE WHEN s = 3 THEN 'assistant:' ELSE 'user:' END || CASE edit WHEN 'R' THEN text ELSE '' END) END
            FROM (
                SELECT w.*, role, text, k, m, CASE WHEN fault IS NOT NULL AND here = 3 + after[s] THEN 'D' WHEN here = 2 + costs.c[m] THEN 'I'
                    WHEN fault NOT IN ('b', 'd') AND here = (fault = 't')::INT + after[k] THEN 'K' ELSE 'R' END AS edit
                FROM (
                    SELECT walk.*, [3, 3, 4, 3][s] AS m, r.role, r.text, r.fault, here.c[s] AS here, here.c AS now, next.c AS after,
                        CASE WHEN s = 1 AND initial = 's' THEN 2 WHEN s <> 3 AND initial = 'u' THEN 3 WHEN s = 3 AND initial = 'a' THEN 4 END AS k
                    FROM walk JOIN costs here ON here.conv_id IS NOT DISTINCT FROM walk.conv_id AND here.i = walk.i
                    LEFT JOIN costs next ON next.conv_id IS NOT DISTINCT FROM walk.conv_id AND next.i = walk.i + 1
                    LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM walk.conv_id AND r.i = walk.i + 1
                    WHERE next.i IS NOT NULL OR s NOT IN (1, 4)
                ) w JOIN costs ON costs.conv_id IS NOT DISTINCT FROM w.conv_id AND costs.i = w.i
            )
        ),
        ended AS (SELECT conv_id, arg_max(audit, length(audit)) AS audit, arg_max(kept, length(audit)) AS kept FROM walk GROUP BY 1)
        SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
            coalesce(illegal, 0)::BIGINT AS illegal, coalesce(costs.c[1], 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM given) g LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM g.conv_id
        LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN costs ON costs.conv_id IS NOT DISTINCT FROM g.conv_id AND costs.i = 0
    """,
    "op12_divergence": r"""
        WITH t AS (
            SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w,
                row_number() OVER () AS row FROM documents
        ),
        w AS (SELECT lang, source, row, unnest(w) AS term FROM t),
        kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT row) >= 10),
        c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY 1),
        g AS (SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM t) LEFT JOIN l USING (lang) LEFT JOIN c USING (lang, source) GROUP BY ALL),
        p AS (
            SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.total + 2 * g.v) AS p,
                1 + 1000000000::HUGEINT * (kept.n + 2) // (l.total + 2 * l.v) AS q
            FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
        ),
        f AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term WHERE x.term IS NULL OR y.term IS NOT NULL GROUP BY ALL
            UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
        ),
        r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM f)
        SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
    """,
}
