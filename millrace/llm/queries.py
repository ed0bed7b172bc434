"""The registered queries of this folder: name to function of (spark, folder), and SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, decontaminate, host_rules, merkle, mixing, nbsvm, ngram_join, paragraphs, pieces_scan, prefix_tokens, toxicity, variants, wrappers

QUERIES = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


@_query()
def op1_substring_dedup(spark, folder):
    return paragraphs.deduplicated(_table(spark, folder, "documents"))


@_query()
def op2_html_extraction(spark, folder):
    return wrappers.main_text(_table(spark, folder, "pages"))


@_query()
def op3_token_counts(spark, folder):
    return prefix_tokens.token_counts(_table(spark, folder, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"


@_query(
    f"""
    WITH t AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
                 regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
    lines AS (SELECT doc_id, i, l FROM (SELECT doc_id, unnest(str_split(text, chr(10))) AS l,
                 generate_subscripts(str_split(text, chr(10)), 1) AS i FROM t) WHERE regexp_matches(l, {_WORD})),
    line_counts AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM lines GROUP BY doc_id),
    grams AS (SELECT doc_id, i, w[i : i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
    twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    repeats AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM
                 (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
    m AS (SELECT doc_id, host, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
            length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
            coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
          FROM t LEFT JOIN line_counts USING (doc_id) LEFT JOIN repeats USING (doc_id)),
    long AS (SELECT doc_id, host, 'symbols' AS rule, 5 * n_symbols > n_words AS bad FROM m
             UNION ALL SELECT doc_id, host, 'dup_lines', n_dup_lines > 3 AND 10 * n_dup_lines > 3 * n_lines FROM m
             UNION ALL SELECT doc_id, host, 'word_length', word_chars < 2 * n_words OR word_chars > 20 * n_words FROM m),
    hosts AS (SELECT rule, host, count(*) AS n, sum(bad::INT) AS bad FROM long GROUP BY ALL),
    totals AS (SELECT rule, sum(n) AS n, count(*) AS hosts, sum(n * n) AS nn, sum(bad) / sum(n) AS mean, sum(bad * bad / n) AS sq FROM hosts GROUP BY rule),
    apart AS (SELECT *, mean * (1 - mean) AS chance, (sq - n * mean * mean - (hosts - 1) * mean * (1 - mean)) / nullif(n - nn / n, 0) AS apart FROM totals),
    prior AS (SELECT rule, mean, CASE WHEN apart > 0 THEN least(1e6, greatest(1, chance / apart - 1)) ELSE 1e6 END AS weight FROM apart),
    rates AS (SELECT rule, host, (bad + weight * mean) / (n + weight) AS rate FROM hosts JOIN prior USING (rule)),
    verdict AS (SELECT doc_id, bool_or(bad AND rate > 0.02) AS bad FROM long JOIN rates USING (rule, host) GROUP BY doc_id)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
      NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT bad AS kept
    FROM m JOIN verdict USING (doc_id)"""
)
def op4_quality_rules(spark, folder):
    return host_rules.verdicts(_table(spark, folder, "documents"))


@_query()
def op5_quality_classifier(spark, folder):
    docs = _table(spark, folder, "documents")
    model = nbsvm.fitted(docs, _table(spark, folder, "labels"), "quality", nbsvm.fold("doc_id", 5) != 0)
    return _judged(nbsvm.scores(docs, model), nbsvm.fold("doc_id", 5) == 0)


def _judged(scored: DataFrame, held_out, *more: str) -> DataFrame:
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), *more)


def _esc(column: str) -> str:
    return f"length(replace(replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'), ']', '&rb;'))"


@_query(
    f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    o AS (SELECT *, row_number() OVER w AS i, lag(role) OVER w IS DISTINCT FROM role AS begins
          FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
      (sum({_esc("text")}) + sum(CASE WHEN begins THEN 12 + 2 * {_esc("role")} ELSE 3 END))::BIGINT AS formatted_chars,
      sum(begins::INT)::BIGINT AS n_blocks
    FROM o GROUP BY conv_id"""
)
def op6_chat_formatting(spark, folder):
    text = "</s>[INST] ok [/INST]"
    more = spark.sql("SELECT -7L AS conv_id, t AS turn, r AS role, x AS text FROM VALUES (0L, 'user', :x), (1L, 'assistant', :x) AS v(t, r, x)", {"x": text})
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.formatted(rows))


@_query()
def op7_sentencepiece(spark, folder):
    rows = pieces_scan.encoded(_table(spark, folder, "documents"))
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "round_trip", "ids")


@_query()
def op8_toxicity(spark, folder):
    docs = _table(spark, folder, "documents")
    model = toxicity.fitted(docs, _table(spark, folder, "labels"), "toxic", nbsvm.fold("doc_id", 4) != 2)
    return _judged(toxicity.scores(docs, model), nbsvm.fold("doc_id", 4) == 2, "sentences")


@_query(
    f"""
    WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS g FROM t)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    links AS (SELECT p.x, p.y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2) p
              JOIN n a ON a.doc_id = p.x JOIN n b ON b.doc_id = p.y WHERE 100 * c >= 75 * (a.n + b.n - c)),
    reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
    SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(r.y, doc_id)) AS component_id
    FROM t LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS y FROM reach GROUP BY x) r USING (doc_id)"""
)
def op9_ngram_jaccard_join(spark, folder):
    return ngram_join.similarity_classes(_table(spark, folder, "documents"))


@_query(
    rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
    win AS (SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    pos AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
    occ AS (SELECT doc_id, i, k, item_id FROM pos JOIN win USING (k, g)),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY doc_id),
    ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
            FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)"""
)
def op10_benchmark_decontamination(spark, folder):
    return decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))

_SIZE = f"len(regexp_extract_all(coalesce(text, ''), {_WORD}))"


@_query(
    f"""
    WITH RECURSIVE d AS (SELECT doc_id, source, {_SIZE}::BIGINT AS size,
        ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '-' || text, '-')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS i FROM d GROUP BY source),
    w AS (SELECT source, n, ([3, 1, 2])[i % 3 + 1]::DOUBLE AS w, 2.0::DOUBLE * n AS cap FROM s),
    -- the sources at their limits, round by round
    rounds AS (SELECT 0 AS r, (SELECT sum(n) * 1.5::DOUBLE / sum(w) FROM w) AS level
        UNION ALL
        SELECT r + 1, (SELECT ((SELECT sum(n) FROM w) * 1.5::DOUBLE - coalesce(sum(cap) FILTER (cap <= level * w), 0))
                  / ((SELECT sum(w) FROM w) - coalesce(sum(w) FILTER (cap <= level * w), 0)) FROM w)
        FROM rounds WHERE r < 60),
    last AS (SELECT level FROM rounds WHERE r = 60),
    t AS (SELECT source, n, CASE WHEN cap <= level * w THEN cap ELSE level * w END AS target FROM w, last)
    SELECT doc_id, size, n AS source_size, target,
      (size * CASE WHEN n = 0 THEN 0 ELSE floor(target / n) + (u < target / n - floor(target / n))::INT END)::BIGINT AS taken
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source"""
)
def op11_source_mixing(spark, folder):
    rows = mixing.repetitions(_table(spark, folder, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def _crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    code = f"hex(encode({text}))"
    octets = f"list_transform(range(0, length({code}) // 2), lambda i: ('0x' || substr({code}, 2 * i + 1, 2))::BIGINT)"
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {bits}), 4294967295)"


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


@_query(
    f"""
    WITH RECURSIVE d AS (SELECT doc_id, lang, {_leaf("text")} AS leaf,
        CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
        FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
    up AS (SELECT lang, 0 AS lvl, i, leaf AS h, n FROM r
        UNION ALL SELECT lang, lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM up WHERE n > 1 GROUP BY lang, lvl, i // 8),
    sub AS (SELECT lang, h, row_number() OVER (ORDER BY lang COLLATE "C" NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
    top AS (SELECT 0 AS lvl, i, h, n FROM sub
        UNION ALL SELECT lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM top WHERE n > 1 GROUP BY lvl, i // 8),
    a AS (SELECT x.lang, x.lvl, x.i, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS l, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS g
        FROM up x JOIN up y ON x.lang IS NOT DISTINCT FROM y.lang AND x.lvl = y.lvl AND x.i // 8 = y.i // 8 WHERE x.n > 1 GROUP BY ALL),
    b AS (SELECT x.lvl, x.i, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS l, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS g
        FROM top x JOIN top y ON x.lvl = y.lvl AND x.i // 8 = y.i // 8 WHERE x.n > 1 GROUP BY ALL),
    fold AS (SELECT doc_id, lang, leaf, 0 AS step, i, coalesce(changed, leaf) AS acc, '' AS sibs FROM r
        UNION ALL SELECT f.doc_id, f.lang, f.leaf, step + 1, f.i // 8, sha256(l || acc || g), sibs || l || g
        FROM fold f JOIN a ON a.lang IS NOT DISTINCT FROM f.lang AND a.lvl = f.step AND a.i = f.i),
    low AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY doc_id, lang, leaf ORDER BY step DESC) = 1),
    over_ AS (SELECT doc_id, leaf, s.h AS subroot, 0 AS step, s.i, acc, sibs FROM low JOIN sub s ON s.lang IS NOT DISTINCT FROM low.lang
        UNION ALL SELECT o.doc_id, o.leaf, o.subroot, step + 1, o.i // 8, sha256(l || acc || g), sibs || l || g FROM over_ o JOIN b ON b.lvl = o.step AND b.i = o.i),
    done AS (SELECT * FROM over_ QUALIFY row_number() OVER (PARTITION BY doc_id, leaf ORDER BY step DESC) = 1)
    SELECT doc_id, leaf, subroot, top.h AS root, sha256(sibs) AS proof_sha256, acc AS folded_root, acc = top.h AS verified FROM done, top WHERE top.n = 1"""
)
def op12_merkle_manifest(spark, folder):
    return merkle.audit(_table(spark, folder, "documents"))


@_query(
    f"""
    WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM documents),
    each_ AS (SELECT doc_id, r, count(*) AS k FROM runs WHERE length(r) >= 7 GROUP BY ALL),
    hashed AS (SELECT r, k, {_crc32("doc_id || ':' || r")} AS h FROM each_),
    words AS (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word, k FROM hashed),
    v AS (SELECT word, sum(k)::BIGINT AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
    cut AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
    parts AS (SELECT word, n, substr(word, 1, i - 1) AS x, substr(word, i + 1) AS y FROM cut),
    near AS (SELECT a.word, b.word AS other, b.n AS m FROM parts a JOIN parts b ON a.x = b.x AND a.y = b.y AND a.word <> b.word
        UNION SELECT p.word, v.word, v.n FROM parts p JOIN v ON v.word = p.x || p.y
        UNION SELECT v.word, p.word, p.n FROM parts p JOIN v ON v.word = p.x || p.y),
    best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other COLLATE "C")) AS other, max(m) AS m FROM near GROUP BY word),
    f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
        FROM v LEFT JOIN best USING (word)),
    chain AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN f ON f.word = c.next)
    SELECT f.word, form, c.at AS root, n, n_near, form_n FROM f JOIN chain c ON c.word = f.word AND c.next IS NULL"""
)
def op13_spelling_variants(spark, folder):
    return variants.grouped(_table(spark, folder, "documents"))
