"""The dealt operators as queries over the whole of their tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat_format, conversation_repair, decontaminate, language_id, line_dedup, packing, quality_classifier,
    quality_rules, sharding, simhash_dedup, spelling, substring_dedup, token_files,
)
from tidemark.llm.common import crc_mod
from tidemark.llm.quality_sql import quality_sql
from tidemark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: For items of at least five words, as all of the test tables are.
_OP1_SQL = """
WITH items AS (
    SELECT item_id, w, len(w) AS n FROM (
        SELECT item_id, regexp_extract_all(lower(text), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM benchmark)
    WHERE len(w) >= 5),
wanted AS (
    SELECT item_id, n, k, count(*) AS c FROM (
        SELECT item_id, n, list_slice(w, i, i + 4) AS k
        FROM (SELECT *, unnest(range(1, n - 3)) AS i FROM items)) GROUP BY ALL),
docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(lower(text), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
shingles AS (
    SELECT r, i, list_slice(w, i, i + 4) AS k
    FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM docs)),
windows AS (
    SELECT DISTINCT s.r, t.item_id, t.n, s.i - d AS start
    FROM shingles s JOIN wanted t USING (k), range(0, 1000) o(d)
    WHERE d <= t.n - 5 AND s.i - d >= 1),
common AS (
    SELECT w.r, w.item_id, w.n, w.start, t.k, least(count(*), any_value(t.c)) AS c
    FROM windows w JOIN shingles s ON s.r = w.r AND s.i BETWEEN w.start AND w.start + w.n - 5
    JOIN wanted t ON t.item_id = w.item_id AND t.k = s.k GROUP BY 1, 2, 3, 4, 5),
alike AS (
    SELECT r, item_id, n, start, sum(c) / (2 * (n - 4) - sum(c)) AS similarity
    FROM common GROUP BY r, item_id, n, start)
SELECT doc_id, item_id, max(similarity) AS similarity,
    arg_min(start, (-similarity, start)) - 1 AS start, any_value(a.n)::BIGINT AS n_words
FROM alike a JOIN docs USING (r)
WHERE similarity >= 0.8 AND start + a.n - 1 <= len(w) GROUP BY r, doc_id, item_id
"""


@query("op1_decontaminate", _OP1_SQL)
def op1(spark, sf_dir):
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.leaks(docs, items)


_OP2_SQL = f"""
WITH lines AS (
    SELECT doc_id, text, i, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w, line
    FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
            generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
found AS (SELECT doc_id, i, w, list_aggregate(w, 'string_agg', ' ') AS s FROM lines WHERE len(w) > 0),
classes AS (SELECT s, any_value(w) AS w, min((doc_id, i)) AS first FROM found GROUP BY s),
long AS (SELECT s, w, first, len(w) AS n, unnest(range(1, len(w) + 1)) AS j
    FROM classes WHERE len(w) >= {line_dedup.MIN_WORDS}),
opened AS (SELECT s, first, n, j, w[:j - 1] AS a, w[j + 1:] AS b FROM long),
replaced AS (SELECT a.s FROM opened a JOIN (
        SELECT n, j, a, b, min(first) AS earliest FROM opened GROUP BY ALL HAVING count(*) > 1) e
    ON a.n = e.n AND a.j = e.j AND a.a = e.a AND a.b = e.b AND e.earliest < a.first),
shorter AS (SELECT DISTINCT s, first, list_aggregate(a || b, 'string_agg', ' ') AS d
    FROM opened WHERE n > {line_dedup.MIN_WORDS}),
inserted AS (
    SELECT x.s FROM shorter x JOIN classes c ON c.s = x.d WHERE c.first < x.first
    UNION ALL
    SELECT c.s FROM shorter x JOIN classes c ON c.s = x.d WHERE x.first < c.first),
near AS (SELECT DISTINCT s FROM (FROM replaced UNION ALL FROM inserted)),
gone AS (SELECT f.doc_id, f.i FROM found f JOIN classes c USING (s)
    WHERE (f.doc_id, f.i) <> c.first OR f.s IN (FROM near))
SELECT l.doc_id, count(*) FILTER (len(w) > 0) AS n_lines, count(g.i) AS n_removed,
    md5(coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '')) AS text_md5
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id
"""


@query("op2_line_dedup", _OP2_SQL)
def op2(spark, sf_dir):
    left = line_dedup.line_report(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


@query("op3_quality_rules", quality_sql())
def op3(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


#: crc32 of the text, byte by byte, from its table of 256 remainders.
_CRC32 = """
    SELECT list(r ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, [1, 2, 3, 4, 5, 6, 7, 8]), lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS r
        FROM (SELECT unnest(range(256)) AS i))
"""

_OP4_SQL = f"""
WITH remainders AS ({_CRC32}),
rows AS (
    SELECT doc_id, coalesce('=' || source, '') AS s, md5('{sharding.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS k,
        octet_length(encode(coalesce(text, ''))) + 1 AS size, encode(coalesce(text, '')) AS b,
        xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(
                list_filter(string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\\1 ', 'g'),
                    ' '), lambda h: h <> ''),
                lambda h: ('0x' || h)::BIGINT)),
            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS crc
    FROM documents, remainders),
ranked AS (
    SELECT *, (row_number() OVER (PARTITION BY s ORDER BY k, size, crc) - 1 + 0.5::DOUBLE)
        / count(*) OVER (PARTITION BY s) AS spot FROM rows),
placed AS (
    SELECT *, row_number() OVER (ORDER BY spot, s, k, size, crc) - 1 AS place, count(*) OVER () AS n
    FROM ranked)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law,
    (place * {sharding.SHARDS} // n)::INTEGER AS shard,
    (place - ((place * {sharding.SHARDS} // n) * n + {sharding.SHARDS - 1}) // {sharding.SHARDS})::BIGINT AS slot,
    NULL::INTEGER AS grown_shard
FROM placed
"""


@query("op4_sharding", _OP4_SQL)
def op4(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharding.interleave(docs, ["size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_language_id")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(crc_mod("doc_id", 4) != 2))
    return language_id.classify(docs, model).select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


_OP6_SQL = f"""
WITH turns AS (
    SELECT DISTINCT conv_id // 2 AS pair_id, conv_id % 2 AS side, coalesce(turn, {2**63 - 1}) AS turn,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) AS k FROM turns),
same AS (
    SELECT pair_id, k, count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS alike
    FROM placed GROUP BY pair_id, k),
prompts AS (
    SELECT pair_id, coalesce(min(k) FILTER (NOT alike) - 1, max(k)) AS n FROM same GROUP BY pair_id),
rendered AS (
    SELECT pair_id, side, k, n, k <= n AS shared, role, '{chat_format.OPEN}' || role || chr(10) AS head,
        text || '<|im_end|>' || chr(10) AS body
    FROM placed JOIN prompts USING (pair_id)),
spans AS (
    SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY pair_id, side, shared ORDER BY k)
        - length(body) AS start FROM rendered),
sides AS (
    SELECT pair_id, side, any_value(n) AS n,
        coalesce(string_agg(head || body, '' ORDER BY k) FILTER (shared), '') AS prompt,
        coalesce(string_agg(head || body, '' ORDER BY k) FILTER (NOT shared), '') AS completion,
        coalesce(string_agg(start || ':' || length(body), ',' ORDER BY k)
            FILTER (NOT shared AND role = '{chat_format.TRAINED}'), '') AS spans
    FROM spans GROUP BY pair_id, side),
pairs AS (
    SELECT pair_id, any_value(n) AS n, coalesce(max(prompt), '') AS prompt,
        coalesce(max(completion) FILTER (side = 0), '') AS chosen,
        coalesce(max(completion) FILTER (side = 1), '') AS rejected,
        coalesce(max(spans) FILTER (side = 0), '') AS chosen_spans,
        coalesce(max(spans) FILTER (side = 1), '') AS rejected_spans
    FROM sides GROUP BY pair_id)
SELECT pair_id, n::INTEGER AS n_prompt_turns, md5(prompt) AS prompt_md5, md5(chosen) AS chosen_md5,
    md5(rejected) AS rejected_md5, chosen_spans, rejected_spans,
    chosen_spans <> '' AND rejected_spans <> '' AND chosen <> rejected AS usable
FROM pairs
"""


@query("op6_chat_format", _OP6_SQL)
def op6(spark, sf_dir):
    turns = chat_format.neighbours(table(spark, sf_dir, "conversations"))

    def listed(name):
        return F.array_join(F.transform(name, lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["length"].cast("string"))), ",").alias(name)

    return chat_format.format_preferences(turns).select(
        "pair_id", "n_prompt_turns", *[F.md5(c).alias(f"{c}_md5") for c in ("prompt", "chosen", "rejected")],
        listed("chosen_spans"), listed("rejected_spans"), "usable",
    )


_OP7_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
    SELECT r, doc_id, i, list_slice(w, i, i + {substring_dedup.WINDOW - 1}) AS k
    FROM (SELECT *, unnest(range(1, len(w) - {substring_dedup.WINDOW - 2})) AS i FROM docs)),
firsts AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
gone AS (
    SELECT DISTINCT r, i + j AS i FROM windows JOIN firsts USING (k), range({substring_dedup.WINDOW}) s(j)
    WHERE first < doc_id),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs),
kept AS (
    SELECT w.r, count(g.i) AS n, string_agg(word, ' ' ORDER BY w.i) FILTER (g.i IS NULL) AS text
    FROM words w LEFT JOIN gone g ON w.r = g.r AND w.i = g.i GROUP BY w.r)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


@query("op7_substring_dedup", _OP7_SQL)
def op7(spark, sf_dir):
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


@query("op8_best_fit_packing")
def op8(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op9_quality_classifier")
def op9(spark, sf_dir):
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    model = quality_classifier.train(docs, labels.where(crc_mod("doc_id", 5) != 0))
    return quality_classifier.classify(docs, model).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op10_simhash_dedup")
def op10(spark, sf_dir):
    return simhash_dedup.near_duplicate_groups(table(spark, sf_dir, "documents"))


def _crc32(text: str) -> str:
    """crc32 of a text by the remainders ``t``."""
    octets = f"""list_transform(list_filter(string_split(
        regexp_replace(hex(encode({text})), '(..)', '\\1 ', 'g'), ' '), lambda h: h <> ''),
        lambda h: ('0x' || h)::BIGINT)"""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, {octets}),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])))"""


_OP11_SQL = f"""
WITH RECURSIVE remainders AS ({_CRC32}),
found AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS raw FROM documents)
    WHERE length(raw) >= {spelling.MIN_LENGTH}),
hashed AS (
    SELECT run, c, {_crc32("d || ':' || run")} AS h
    FROM (SELECT d, run, count(*) AS c FROM found GROUP BY d, run), remainders),
words AS (
    SELECT word, sum(c)::BIGINT AS n FROM (
        SELECT c, CASE WHEN h % {spelling.DAMAGE} <> 0 THEN run
            ELSE substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) END AS word FROM hashed)
    WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY word HAVING sum(c) >= {spelling.MIN_COUNT}),
opened AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
    SELECT a.word, b.word AS near FROM opened a JOIN opened b
        ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT o.word, w.word FROM opened o JOIN words w ON o.rest = w.word
    UNION SELECT w.word, o.word FROM opened o JOIN words w ON o.rest = w.word),
best AS (
    SELECT p.word, count(*) AS n_near, arg_min(near, (-w.n, near)) AS near, max(w.n) AS near_n
    FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {spelling.RATIO} * n THEN near END AS form,
        CASE WHEN near_n >= {spelling.RATIO} * n THEN near_n END AS form_n
    FROM words LEFT JOIN best USING (word)),
chain AS (
    SELECT word, word AS root FROM forms
    UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (
    SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""


@query("op11_spelling_variants", _OP11_SQL)
def op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return spelling.group_variants(spelling.count_words(docs, spelling.DAMAGE))


def _repair_state(state: str, keep: str, nexts: str) -> str:
    """The best of (cost, initials, lines) from a state before a turn, without insertions.
    ``keep``: state after a kept turn, by role; ``nexts``: after one that is rerolled."""
    role = "user" if nexts == "u" else "assistant"
    kept = "\n".join(
        f"WHEN r.role[1] = '{own}' THEN {{'c': b.{to}.c + r.cut, 'a': 'K' || b.{to}.a, "
        f"'t': list_prepend(r.role || ':' || r.text, b.{to}.t)}}"
        for own, to in (pair.split(">") for pair in keep.split()))
    return f"""list_min([
        {{'c': b.{state}.c + 3, 'a': 'D' || b.{state}.a, 't': b.{state}.t}},
        CASE WHEN r.bad THEN NULL {kept} END,
        CASE WHEN NOT r.bad THEN {{'c': b.{nexts}.c + 2 + r.cut, 'a': 'R' || b.{nexts}.a,
            't': list_prepend('{role}:' || r.text, b.{nexts}.t)}} END])"""


def _repair_inserts(state: str, one: str, two: str) -> str:
    """The best from a state before a turn, with up to two insertions."""
    first, second = ("user:", "assistant:") if one == "u" else ("assistant:", "user:")
    return f"""list_min([d.{state},
        {{'c': d.{one}.c + 2, 'a': 'I' || d.{one}.a, 't': list_prepend('{first}', d.{one}.t)}},
        {{'c': d.{two}.c + 4, 'a': 'II' || d.{two}.a,
            't': list_prepend('{first}', list_prepend('{second}', d.{two}.t))}}])"""


_OP12_SQL = f"""
WITH RECURSIVE remainders AS ({_CRC32}),
hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS d
    FROM conversations, remainders),
damaged AS (
    SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
        CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed WHERE d <> 0),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id
            ORDER BY turn NULLS FIRST, role, text[:{conversation_repair.PREFIX}], md5(text)) AS i,
        trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
marked AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
        coalesce(lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1]
            NOT IN ('su', 'ua', 'au'), false) AS illegal,
        count(*) OVER (PARTITION BY conv_id) AS n FROM numbered),
turns AS (
    SELECT *, bare = '' AS blank, bare <> '' AND again AS duplicate,
        bare <> '' AND NOT again AND bare[-1] NOT IN ('.', '!', '?') AS truncated,
        bare = '' OR again AS bad,
        (bare <> '' AND NOT again AND bare[-1] NOT IN ('.', '!', '?'))::BIGINT AS cut FROM marked),
steps AS (
    SELECT conv_id, n + 1 AS i, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS z,
        {{'c': 4::BIGINT, 'a': 'II', 't': ['user:', 'assistant:']}} AS s,
        {{'c': 2::BIGINT, 'a': 'I', 't': ['assistant:']}} AS u,
        {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS a
    FROM turns WHERE i = n
    UNION ALL
    SELECT conv_id, i, {_repair_inserts("z", "u", "a")}, {_repair_inserts("s", "u", "a")},
        {_repair_inserts("u", "a", "u")}, {_repair_inserts("a", "u", "a")}
    FROM (
        SELECT r.conv_id, r.i, {_repair_state("z", "s>s u>u", "u")} AS z,
            {_repair_state("s", "u>u", "u")} AS s, {_repair_state("u", "a>a", "a")} AS u,
            {_repair_state("a", "u>u", "u")} AS a
        FROM steps b JOIN turns r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i - 1) d),
found AS (
    SELECT conv_id, z.c AS cost, z.a AS audit, array_to_string(z.t, chr(10)) AS repaired FROM steps WHERE i = 1),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
        count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
    FROM turns GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
    sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN found f ON o.conv_id IS NOT DISTINCT FROM f.conv_id
"""


@query("op12_conversation_repair", _OP12_SQL)
def op12(spark, sf_dir):
    given = table(spark, sf_dir, "conversations")
    damaged = conversation_repair.damage(given)
    done = conversation_repair.repair(damaged)
    out = given.select("conv_id").distinct()
    for part in (conversation_repair.gaps(damaged), done.report, conversation_repair.digests(done.turns)):
        out = conversation_repair.join_null_safe(out, part)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op13_token_files")
def op13(spark, sf_dir):
    folder = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder)
    return token_files.read_tokens(spark, folder)
