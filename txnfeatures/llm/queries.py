"""Every operator over its whole table, with a SQL twin where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minmax_near_dedup(spark, sf_dir):
    from txnfeatures.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op2_hidden_markov_lm(spark, sf_dir):
    from txnfeatures.llm.hmm import is_held_out, train

    docs = table(spark, sf_dir, "documents")
    return train(docs.where(~is_held_out())).score(docs, held_out=is_held_out())


def op4_repetition_coverage(spark, sf_dir):
    from txnfeatures.llm.repetition import measure

    return measure(table(spark, sf_dir, "documents"))


def op3_two_pass_shuffle(spark, sf_dir):
    from txnfeatures.llm.shuffle import shuffle_into_shards

    text = F.coalesce("text", F.lit(""))
    return shuffle_into_shards(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_addressable_codes(spark, sf_dir):
    import public_tokenizers

    from txnfeatures.llm.dac import read_codes, write_codes

    uri = write_codes(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_codes(spark, uri)


def op6_pivotal_mixing(spark, sf_dir):
    from txnfeatures.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


def op8_seeded_alignment(spark, sf_dir):
    from txnfeatures.llm.decontaminate import matches

    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op7_template_lines(spark, sf_dir):
    from txnfeatures.llm.templates import drop_templates

    return drop_templates(table(spark, sf_dir, "documents"))


def op9_chat_segments(spark, sf_dir):
    from txnfeatures.llm.chat import digest, format_turns, read_turns
    from txnfeatures.llm.store import stored

    said = r"\### Assistant: </turn> ok"
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(planted)
    return digest(read_turns(stored(format_turns(rows), "chat")))


def op10_anchor_expansion(spark, sf_dir):
    from txnfeatures.llm.pii import BASE_KINDS, find_spans, written

    found = find_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    return found.select(
        "doc_id",
        *[(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written("spans").alias("spans"),
    )


def op11_byte_gru_language(spark, sf_dir):
    from txnfeatures.llm.hmm import is_held_out
    from txnfeatures.llm.langid import train_identifier

    docs, held_out = table(spark, sf_dir, "documents"), is_held_out(parts=4)
    return train_identifier(docs.where(~held_out)).predict(docs, held_out=held_out)


def op12_trie_collocations(spark, sf_dir):
    from txnfeatures.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


def op13_reduced_spelling(spark, sf_dir):
    from txnfeatures.llm.spelling import group_variants

    return group_variants(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_minmax_near_dedup": op1_minmax_near_dedup,
    "op2_hidden_markov_lm": op2_hidden_markov_lm,
    "op3_two_pass_shuffle": op3_two_pass_shuffle,
    "op4_repetition_coverage": op4_repetition_coverage,
    "op5_addressable_codes": op5_addressable_codes,
    "op6_pivotal_mixing": op6_pivotal_mixing,
    "op7_template_lines": op7_template_lines,
    "op8_seeded_alignment": op8_seeded_alignment,
    "op9_chat_segments": op9_chat_segments,
    "op10_anchor_expansion": op10_anchor_expansion,
    "op11_byte_gru_language": op11_byte_gru_language,
    "op12_trie_collocations": op12_trie_collocations,
    "op13_reduced_spelling": op13_reduced_spelling,
    "pipeline": pipeline,
}

# SQL of DuckDB.  Operators that draw, train, align or encode have none; tests hold those against brute force.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

NEAR_DEDUP = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(LOWER)} AS words FROM documents),
grams AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
        WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS g
    FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS s, doc_id AS t FROM documents UNION SELECT r.s, e.b FROM reach r JOIN edges e ON r.t = e.a),
named AS (SELECT s AS doc_id, min(t) AS component_id FROM reach GROUP BY s)
SELECT named.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, named.doc_id = component_id AS kept
FROM named LEFT JOIN sizes ON sizes.doc_id = named.doc_id
"""


def _coverage(n: int) -> str:
    """Words and word characters inside windows of ``n`` words that a text has twice or more."""
    return f"""(
  SELECT x.doc_id, count(*) AS words_in, sum(length(words[x.pos])) AS chars_in FROM (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + {n})) AS pos
    FROM (
      SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, g) AS times FROM (
        SELECT doc_id, unnest(range(1, len(words) - {n - 2})) AS pos,
          unnest(list_transform(range(1, len(words) - {n - 2}), lambda i: words[i:i + {n - 1}])) AS g
        FROM w WHERE len(words) >= {n}))
    WHERE times > 1) x JOIN w ON w.doc_id = x.doc_id GROUP BY x.doc_id)"""


def _repetition_sql() -> str:
    from txnfeatures.llm.repetition import COVERAGE, LINE_COVERAGE, MIN_WORDS, REPEAT_PERCENT, REPEAT_WINDOW

    chars = ", ".join(f"CAST(coalesce(c{n}.chars_in, 0) AS BIGINT) AS repeat_chars_{n}" for n in COVERAGE)
    joins = " ".join(f"LEFT JOIN {_coverage(n)} c{n} ON c{n}.doc_id = w.doc_id" for n in COVERAGE)
    good = " AND ".join(f"100 * repeat_chars_{n} <= {p} * word_chars" for n, p in COVERAGE.items())
    failed = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words)"
    return f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS words FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
again AS (
  SELECT doc_id, sum(n - 1) AS n_dup_lines, sum((n - 1) * length(line)) AS dup_line_chars FROM (
    SELECT doc_id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1, 2)
  GROUP BY 1),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(a.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.words_in, 0) AS BIGINT) AS n_repeat_words, {chars},
    CAST(length(text) AS BIGINT) AS chars, CAST(coalesce(a.dup_line_chars, 0) AS BIGINT) AS dup_line_chars
  FROM w LEFT JOIN again a ON a.doc_id = w.doc_id
    LEFT JOIN {_coverage(REPEAT_WINDOW)} r ON r.doc_id = w.doc_id {joins})
SELECT *, {failed} AS base_failed,
  NOT {failed} AND {good} AND 100 * dup_line_chars <= {LINE_COVERAGE} * chars AS kept
FROM m
"""


CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
c AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS was,
    lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS next,
    length(replace(replace(replace(text, '\', '\s'), '<', '\l'), '#', '\h')) AS body,
    length(replace(replace(replace(replace(role, '\', '\s'), '<', '\l'), '#', '\h'), ':', '\c')) AS head
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(4 + head + 2 + body + 8) AS BIGINT) AS formatted_chars,
  bool_and(((coalesce(was, '') || '>' || role) IN
    ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user', 'assistant>tool', 'tool>assistant'))
    AND (next IS NOT NULL OR role = 'assistant')) AS valid
FROM c GROUP BY conv_id
"""

TEMPLATES = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL),
tokens AS (
  SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS tokens FROM lines),
leafed AS (
  SELECT doc_id, text, pos, tokens, array_to_string(tokens, ' ') AS line,
    len(tokens) || ' ' || array_to_string(list_transform(tokens[1:3],
      lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END), ' ') AS leaf
  FROM tokens WHERE len(tokens) > 0),
found AS (
  SELECT * FROM leafed WHERE leaf IN (SELECT leaf FROM leafed GROUP BY leaf HAVING count(DISTINCT text) >= 10)),
same AS (SELECT line FROM leafed GROUP BY line HAVING count(DISTINCT text) >= 2),
parsed AS (
  SELECT leaf, line, docs, unnest(range(len(tokens))) AS pos,
    unnest(list_transform(tokens, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END)) AS token
  FROM (SELECT leaf, line, count(DISTINCT text) AS docs, any_value(tokens) AS tokens FROM found GROUP BY 1, 2)),
agreed AS (
  SELECT leaf, pos, token FROM parsed WHERE token <> '<*>' GROUP BY 1, 2, 3 HAVING sum(docs) >= 10),
templates AS (
  SELECT p.leaf, p.line, string_agg(coalesce(a.token, '<*>'), ' ' ORDER BY p.pos) AS fields
  FROM parsed p LEFT JOIN agreed a ON a.leaf = p.leaf AND a.pos = p.pos AND a.token = p.token
  GROUP BY 1, 2 HAVING 100 * count(a.token) >= 50 * count(*)),
named AS (
  SELECT f.doc_id, f.text, f.pos, t.leaf, t.fields FROM found f JOIN templates t ON t.leaf = f.leaf AND t.line = f.line),
common AS (SELECT leaf, fields FROM named GROUP BY 1, 2 HAVING count(DISTINCT text) >= 10),
gone AS (
  SELECT doc_id, text, pos FROM named JOIN common USING (leaf, fields)
  UNION SELECT doc_id, text, pos FROM leafed JOIN same USING (line)),
kept AS (
  SELECT l.doc_id, l.text, count(*) AS n_lines, count(g.pos) AS n_dropped,
    coalesce(string_agg(CASE WHEN g.pos IS NULL THEN l.line END, chr(10) ORDER BY l.pos), '') AS rest
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.text = l.text AND g.pos = l.pos GROUP BY 1, 2)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, rest AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id AND k.text = d.text
"""

COLLOCATIONS = rf"""
WITH RECURSIVE pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (
  SELECT lang, words FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces) WHERE len(words) > 0),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, length, unnest(list_transform(range(1, len(words) - length + 2), lambda i: array_to_string(words[i:i + length - 1], ' '))) AS phrase
  FROM words, (SELECT unnest(range(1, 6)) AS length) WHERE len(words) >= length),
f AS (SELECT lang, phrase, length, count(*) AS a FROM grams GROUP BY 1, 2, 3 HAVING count(*) >= 100),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE length > 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(w[1:length - 1], ' '), array_to_string(w[2:length], ' ')]) AS phrase
    FROM candidates WHERE length > 2) GROUP BY 1, 2),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.w, c.length, unnest(range(1, c.length)) AS k
  FROM candidates c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase WHERE i.longer IS NULL OR i.longer < c.a),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, t.n,
    CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.length], ' ') JOIN totals t ON t.lang = c.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM worst)
WHERE rank <= 2000
"""

#: crc32 has no function there: its table of 256 remainders, then one step per byte of the UTF-8 text (one or two bytes a letter).
SPELLING = rf"""
WITH RECURSIVE steps AS (
  SELECT i AS byte, i AS c, 0 AS step FROM range(256) t(i)
  UNION ALL SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, step + 1 FROM steps WHERE step < 8),
remainders AS (SELECT list(c ORDER BY byte) AS t FROM steps WHERE step = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS head, unnest(regexp_extract_all({LOWER}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
counted AS (SELECT head, run, count(*) AS times FROM runs WHERE length(run) >= 5 GROUP BY 1, 2),
coded AS (
  SELECT run, times, flatten(list_transform(string_split(head || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END)) AS bytes FROM counted),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(bytes, lambda x: CAST(x AS BIGINT))),
    lambda c, b: xor(c // 256, t[CAST(xor(c, b) % 256 AS BIGINT) + 1])), 4294967295) AS h FROM coded, remainders),
typed AS (
  SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed),
v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cuts AS (
  SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN v b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(n := -near_n, w := encode(near), near := near)) AS best FROM near GROUP BY word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 2 * v.n THEN best.near END AS form,
    CASE WHEN -best.n >= 2 * v.n THEN -best.n END AS form_n
  FROM v LEFT JOIN best ON best.word = v.word),
chain AS (
  SELECT word, word AS root, 0 AS hops FROM forms
  UNION ALL SELECT c.word, f.form, hops + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, hops) AS root FROM chain GROUP BY word)
SELECT forms.word, form, root, n, n_near, CAST(form_n AS BIGINT) AS form_n FROM forms JOIN roots ON roots.word = forms.word
"""

ORACLES: dict[str, str] = {
    "op1_minmax_near_dedup": NEAR_DEDUP,
    "op4_repetition_coverage": _repetition_sql(),
    "op7_template_lines": TEMPLATES,
    "op9_chat_segments": CHAT,
    "op12_trie_collocations": COLLOCATIONS,
    "op13_reduced_spelling": SPELLING,
}
