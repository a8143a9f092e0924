"""One query for each operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamfold.llm import op1_lines, op2_decontaminate, op3_jaccard, op4_chat, op5_quality, op6_media, op7_lm, op8_packing, op9_lengths, op10_substrings, op11_codes, op12_toxicity, op13_phrases


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that is not blank, with the first line of its component."""
    return op1_lines.line_components(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that overlap with benchmark items, by item."""
    return op2_decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_jaccard.jaccard_components(_table(spark, sf_dir, "documents"), words=4, num=85, den=100, links=False)


def op3_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every document's number of links, which the SQL does not give."""
    return op3_jaccard.jaccard_components(_table(spark, sf_dir, "documents"), words=4, num=85, den=100)


#: The control strings' own conversation, which the formatting query adds to its table.
CONTROL_CHAT = ((-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(list(CONTROL_CHAT), "conv_id long, turn long, role string, text string")
    return op4_chat.digests(op4_chat.format_chats(chats.unionByName(own)))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return op5_quality.score(docs, op5_quality.fit(docs, _table(spark, sf_dir, "labels")))


def op6_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_media.media_digests(_table(spark, sf_dir, "documents"))


def op6_tiff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files page by page, one row for each."""
    pages = op6_media.tiff_pages(op6_media.text_media(_table(spark, sf_dir, "documents")))
    return pages.withColumn("samples_sha256", F.sha2("samples", 256)).drop("samples")


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_lm.lm_scores(_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_packing.pack(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length histogram with its suffix sums."""
    return op9_lengths.suffix_sums(op9_lengths.length_histogram(_table(spark, sf_dir, "documents")))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_substrings.remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_codes.vector_codes(_table(spark, sf_dir, "embeddings"))


def op12_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_phrases.phrases(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_decontamination, op3_jaccard_join, op3_jaccard_links, op4_chat_format, op5_quality_classifier, op6_tiff_media, op6_tiff_pages, op7_lm_scores, op8_best_fit_packing, op9_token_counts, op10_substring_dedup, op11_vector_codes, op12_toxicity_scores, op13_collocations, pipeline)}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CODES = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"


_SPAN = op2_decontaminate.SPAN
_EQUAL = " + ".join(f"(d.w[h.i + {k}] = b.w[h.j + {k}])::int" for k in range(_SPAN))
_ESCAPED = "regexp_replace(replace({0}, '\\', '\\\\'), '(" + "|".join("".join(f"\\{c}" if not c.isalnum() else c for c in x) for x in op4_chat.CONTROL) + ")', 'x\\0', 'g')"
_MARKS = len(op4_chat.OPEN) + len(op4_chat.BREAK) + len(op4_chat.CLOSE)

#: Parts, entries and rounds of the vector codes.
_P, _E = 16, 64


def _assigned(book: str) -> str:
    """The nearest entry of each part, and its squared distance."""
    return f"""SELECT vec_id, part, arg_min(k, d * {_E} + k) AS k, min(d) AS d FROM
        (SELECT p.vec_id, p.part, b.k, list_sum([(p.x[i] - b.x[i]) * (p.x[i] - b.x[i]) FOR i IN range(1, len(p.x) + 1)])::BIGINT AS d FROM p JOIN {book} b ON p.part = b.part) GROUP BY vec_id, part"""


def _replaced(assigned: str, book: str) -> str:
    """Each entry's parts' mean, rounded down; unused entries stay."""
    return f"""SELECT b.part, b.k, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN (SELECT part, k, list(v ORDER BY i) AS x FROM
        (SELECT a.part, a.k, i, floor(sum(p.x[i])::DOUBLE / count(*))::BIGINT AS v FROM {assigned} a JOIN p ON a.vec_id = p.vec_id AND a.part = p.part, LATERAL (SELECT unnest(range(1, len(p.x) + 1)) AS i) GROUP BY a.part, a.k, i)
        GROUP BY part, k) m ON b.part = m.part AND b.k = m.k"""


#: Words of pieces, and the phrases of 2 to 3 of them with their counts.
_PIECES = r"string_split_regex({}, '[.,;:!?\x0A-\x0D]')".format(_ASCII_LOWER)

ORACLES = {
    "op11_vector_codes": f"""
        WITH v AS MATERIALIZED (SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             p AS MATERIALIZED (SELECT vec_id, part, e[part * len(e) // {_P} + 1 : (part + 1) * len(e) // {_P}] AS x FROM v, range({_P}) t(part)),
             b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS k, x FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {_E})),
             a1 AS MATERIALIZED ({_assigned("b0")}), b1 AS MATERIALIZED ({_replaced("a1", "b0")}), a2 AS MATERIALIZED ({_assigned("b1")}), b2 AS MATERIALIZED ({_replaced("a2", "b1")}), a3 AS MATERIALIZED ({_assigned("b2")}),
             c AS (SELECT vec_id, string_agg(printf('%02x', k), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a3 GROUP BY vec_id),
             s AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, k)) AS codebooks_sha256 FROM b2)
        SELECT c.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM c JOIN v ON c.vec_id = v.vec_id, s""",
    "op13_collocations": f"""
        WITH piece AS MATERIALIZED (SELECT lang, list_filter(string_split_regex(s, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS s FROM documents)),
             f AS MATERIALIZED (SELECT lang, p, any_value(k) AS k, count(*) AS n FROM (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS p FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM piece, (VALUES (1), (2), (3)) t(k))) GROUP BY lang, p),
             cand AS MATERIALIZED (SELECT lang, p, k, n, string_split(p, ' ') AS w FROM f WHERE k >= 2 AND n >= 10),
             gone AS (SELECT c.lang, c.p FROM cand c JOIN (SELECT lang, n, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS p FROM cand WHERE k = 3) l ON c.lang = l.lang AND c.p = l.p WHERE 100 * l.n >= 50 * c.n),
             cut AS (SELECT lang, p, n, j, array_to_string(w[1 : j], ' ') AS x, array_to_string(w[j + 1 :], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS j FROM cand c ANTI JOIN gone g ON c.lang = g.lang AND c.p = g.p)),
             scored AS (SELECT c.lang, c.p AS phrase, c.n AS a, x.n AS l, y.n AS r, (c.n::HUGEINT * c.n * 1000000 // (x.n::HUGEINT * y.n))::BIGINT AS score, j FROM cut c JOIN f x ON c.lang = x.lang AND c.x = x.p JOIN f y ON c.lang = y.lang AND c.y = y.p),
             least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
             ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least),
             total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang)
        SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN total t ON r.lang = t.lang WHERE rank <= 2000""",
    # windows of 13 words of which 11 are equal have four equal words in a row: the SQL needs no masks
    "op2_decontamination": f"""
        WITH d0 AS (SELECT doc_id, {_CODES} AS w, row_number() OVER () AS r FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
             b0 AS (SELECT item_id, {_CODES} AS w, row_number() OVER () AS q FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
             d4 AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 2)) AS i FROM d0)),
             b4 AS (SELECT q, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS g FROM (SELECT q, w, unnest(range(1, len(w) - 2)) AS i FROM b0)),
             h AS (SELECT DISTINCT r, q, i - k AS i, j - k AS j FROM (SELECT r, q, d4.i AS i, b4.i AS j, unnest(range(0, {_SPAN - 3})) AS k FROM d4 JOIN b4 ON d4.g = b4.g)),
             long AS (SELECT doc_id, item_id, {_SPAN} AS n, h.i, h.j, {_EQUAL} AS equal FROM h JOIN d0 d ON h.r = d.r JOIN b0 b ON h.q = b.q
                      WHERE h.i >= 1 AND h.j >= 1 AND h.i + {_SPAN - 1} <= len(d.w) AND h.j + {_SPAN - 1} <= len(b.w)),
             short AS (SELECT doc_id, item_id, len(b.w) AS n, d.i, 1 AS j, len(list_filter(range(0, len(b.w)), lambda k: d.w[d.i + k] = b.w[1 + k])) AS equal
                       FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d0) d JOIN b0 b ON len(b.w) BETWEEN 1 AND {_SPAN - 1} AND d.i + len(b.w) - 1 <= len(d.w)),
             hit AS (SELECT doc_id, item_id, n, i, j, max(equal) AS equal FROM (FROM long UNION ALL FROM short) WHERE equal >= 0.8 * n GROUP BY doc_id, item_id, n, i, j)
        SELECT doc_id, item_id, count(*) AS n_hits, min(i) - 1 AS first_word, max(i + n) - 1 AS last_word, max(equal / n::DOUBLE) AS best FROM hit GROUP BY doc_id, item_id""",
    "op3_jaccard_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({_ASCII_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
             s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] FOR i IN range(1, len(w) - 2)]) END AS s FROM w),
             g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
             links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id
                       GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
             r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, links.b FROM r JOIN links ON r.b = links.a)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.b) AS component_id FROM s JOIN r ON r.a = s.doc_id GROUP BY s.doc_id, s.s""",
    "op4_chat_format": f"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES {", ".join(str(x) for x in CONTROL_CHAT)})
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
               sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + {_MARKS})::BIGINT AS formatted_chars
        FROM c GROUP BY conv_id""",
    "op10_substring_dedup": f"""
        WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
             v AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)),
             late AS (SELECT v.doc_id, v.i FROM v JOIN (SELECT g, min(doc_id) AS first FROM v GROUP BY g) f ON v.g = f.g WHERE f.first < v.doc_id),
             gone AS (SELECT DISTINCT doc_id, i + k AS i FROM (SELECT doc_id, i, unnest(range(0, 13)) AS k FROM late)),
             here AS (SELECT doc_id, i, w[i] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
             kept AS (SELECT h.doc_id, string_agg(h.x, ' ' ORDER BY h.i) AS t, count(*) AS n FROM here h ANTI JOIN gone g ON h.doc_id = g.doc_id AND h.i = g.i GROUP BY h.doc_id)
        SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
        FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id""",
}
