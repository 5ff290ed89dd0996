"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veedor.llm import (
    chat_format, decontamination, exact_dedup, fill_in_middle, jaccard_join, language_id, line_dedup, merkle_manifest, mixing, sharding, substring_dedup, token_count,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digest(chat_format.format_conversations(turns))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_count.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = merkle_manifest.leaf_of({"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))})
    made = merkle_manifest.manifest(_table(spark, sf_dir, "documents"), {"tampered": F.when(tampered, changed)})
    folded = made.withColumns({"proof_sha256": merkle_manifest.proof_digest(), "folded_root": merkle_manifest.fold(F.coalesce("tampered", "leaf"))})
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(fill_in_middle.restored()).alias("restored_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_formatting, op2_exact_dedup, op3_jaccard_join, op4_toxicity, op5_sharding,
        op6_decontamination, op7_mixing, op8_token_counts, op9_language_id, op10_substring_dedup,
        op11_line_dedup, op12_merkle_manifest, op13_fill_in_middle,
    )
}


def _escaped(column: str) -> str:
    """SQL of the length of a text once its control strings and backslashes are escaped."""
    parted = "".join(f", '{c}', '{c[0]}~{c[1:]}')" for c in chat_format.CONTROL)
    return f"(len({'replace(' * len(chat_format.CONTROL)}{column}{parted}) + len({column}) - len(replace({column}, '\\', '')))"


_MARKS = len(chat_format.TURN) + len(chat_format.BODY) + len(chat_format.END)
_BLANK = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
_TEXT13 = "coalesce(text, '')"


def _hash13(k: int) -> str:
    """SQL of the k-th group of eight hex digits of a row's hash, as a number."""
    return f"CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), {8 * k + 1}, 8) AS BIGINT)"


def _units13(upto: str) -> str:
    """SQL of the first lines of a text, with their breaks."""
    return f"(array_to_string(l[1:{upto}], chr(10)) || CASE WHEN {upto} > 0 AND {upto} < len(l) THEN chr(10) ELSE '' END)"


def _leaf12(text: str) -> str:
    parts = [f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


ORACLES: dict[str, str] = {
    "op11_line_dedup": rf"""
WITH l AS (SELECT doc_id, unnest(x) AS line, unnest(range(1, len(x) + 1)) AS j FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
k AS (SELECT *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, max(doc_id) AS keep FROM k WHERE len(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
s AS (SELECT doc_id, line, j, keep IS NOT NULL AND keep <> doc_id AS gone FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY j) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM s GROUP BY doc_id""",
    "op12_merkle_manifest": rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf12("text")} AS leaf, {_leaf12("replace(text, chr(10), '')")} AS changed, crc32_even FROM
  (SELECT *, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
     lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) & 1 = 1 AS crc32_even FROM documents)),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
own AS (SELECT tree, 0 AS level, pos, n, leaf AS h FROM l
  UNION ALL SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM own WHERE n > 1 GROUP BY tree, level, pos // 3, n),
r AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM own WHERE n = 1),
top AS (SELECT 0 AS level, pos, n, h FROM r
  UNION ALL SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 3, n),
up AS (SELECT doc_id, tree, pos, 0 AS level, n, leaf, CASE WHEN crc32_even THEN changed ELSE leaf END AS have, '' AS proof FROM l
  UNION ALL SELECT doc_id, up.tree, up.pos // 3, up.level + 1, (up.n + 2) // 3, leaf, sha256(string_agg(CASE WHEN o.pos = up.pos THEN have ELSE h END, '' ORDER BY o.pos)), proof || coalesce(string_agg(h, '' ORDER BY o.pos) FILTER (WHERE o.pos <> up.pos), '')
    FROM up JOIN own o ON o.tree = up.tree AND o.level = up.level AND o.pos // 3 = up.pos // 3 WHERE up.n > 1 GROUP BY doc_id, up.tree, up.pos, up.level, up.n, leaf, have, proof),
over AS (SELECT doc_id, leaf, r.h AS subroot, r.pos, 0 AS level, r.n, have, proof FROM up JOIN r USING (tree) WHERE up.n = 1
  UNION ALL SELECT doc_id, leaf, subroot, over.pos // 3, over.level + 1, (over.n + 2) // 3, sha256(string_agg(CASE WHEN o.pos = over.pos THEN have ELSE h END, '' ORDER BY o.pos)), proof || coalesce(string_agg(h, '' ORDER BY o.pos) FILTER (WHERE o.pos <> over.pos), '')
    FROM over JOIN top o ON o.level = over.level AND o.pos // 3 = over.pos // 3 WHERE over.n > 1 GROUP BY doc_id, leaf, subroot, over.pos, over.level, over.n, have, proof)
SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(proof) AS proof_sha256, have AS folded_root, have = (SELECT h FROM top WHERE n = 1) AS verified FROM over WHERE n = 1""",
    "op13_fill_in_middle": rf"""
WITH t AS (SELECT doc_id, {_TEXT13} AS text, string_split({_TEXT13}, chr(10)) AS l, {_hash13(0)} AS h1, {_hash13(1)} AS h2, {_hash13(2)} AS h3, {_hash13(3)} AS h4 FROM documents),
u AS (SELECT *, CAST(len(l) - CASE WHEN text = '' OR right(text, 1) = chr(10) THEN 1 ELSE 0 END AS BIGINT) AS n FROM t),
c AS (SELECT *, {_units13("least(h1 % (n + 1), h2 % (n + 1))")} AS p, len({_units13("greatest(h1 % (n + 1), h2 % (n + 1))")}) AS upto,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
x AS (SELECT *, substr(text, len(p) + 1, upto - len(p)) AS m, substr(text, upto + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN len(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM x""",
    "op1_chat_formatting": rf"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, row_number() OVER w AS place, sum({_MARKS} + {_escaped("role")} + {_escaped("text")}) OVER (w ROWS UNBOUNDED PRECEDING) AS upto, count(*) OVER (PARTITION BY conv_id) AS n
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS turns, coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS loss,
  CAST(sum(upto) FILTER (WHERE role = 'assistant' OR place = n) AS BIGINT) AS formatted_chars, count(*) FILTER (WHERE role = 'assistant' OR place = n) AS n_examples FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, len(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars, n_examples FROM g""",
    "op3_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: md5_number(array_to_string(w[i:i+4], ' ')))) AS shingle FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n, bit_xor(shingle) AS node FROM s GROUP BY doc_id),
u AS (SELECT node, any_value(n) AS n, min(doc_id) AS doc_id FROM n GROUP BY node),
r AS (SELECT s.* FROM s JOIN u USING (doc_id)),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM r a JOIN r b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (SELECT a, b FROM shared JOIN u x ON x.doc_id = a JOIN u y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
sides AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (SELECT doc_id AS a, doc_id AS b FROM u UNION SELECT reach.a, sides.b FROM reach JOIN sides ON sides.a = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN u USING (node) LEFT JOIN c ON c.doc_id = u.doc_id""",
    "op10_substring_dedup": r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, i, md5(array_to_string(w[i:i+49], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM p JOIN (SELECT k, min(doc_id) AS least FROM p GROUP BY k) USING (k) WHERE least < doc_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM w WHERE len(w) > 0),
d AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY j) AS said FROM x ANTI JOIN g USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(said, '')) AS kept_sha256 FROM w LEFT JOIN d USING (doc_id)""",
    "op6_decontamination": r"""
WITH w AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
t AS (SELECT kind, id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM w),
s AS (SELECT DISTINCT kind, id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i+4], ' '))) AS shingle
      FROM t WHERE len(w) > 0),
i AS (SELECT id AS item_id, shingle, count(*) OVER (PARTITION BY id) AS n_item FROM s WHERE kind = 'i')
SELECT d.id AS doc_id, item_id, count(*) AS n_shared, n_item, count(*) / n_item AS containment
FROM s d JOIN i USING (shingle) WHERE d.kind = 'd' GROUP BY d.id, item_id, n_item HAVING count(*) >= 0.75 * n_item""",
    "op2_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""",
}
