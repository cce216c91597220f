"""One query per operator over its whole table; SQL beside it where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (
    bpe, cotrain, decontaminate, filteraudit, hilbert, licenses, minhash, pii, preference, projection, tokencount, toxicity,
    turnrepair,
)
from tidelog.llm.frames import read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def _shingle_sql(table: str, key: str) -> str:
    """The distinct five-word shingles of a table's texts; shorter texts are one shingle."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    SELECT DISTINCT {key}, unnest(CASE
        WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
    FROM (SELECT {key}, regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w
          FROM {table} WHERE text IS NOT NULL)"""


def _window_sql(table: str, key: str, widths: str) -> str:
    """The distinct windows of a table's texts, of the widths that `widths` gives for the words w of a text."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    SELECT DISTINCT {key}, width, unnest([array_to_string(w[i:i + width - 1], ' ') FOR i IN range(1, len(w) - width + 2)]) AS shingle
    FROM (SELECT {key}, w, unnest({widths}) AS width FROM (
        SELECT {key}, regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w FROM {table} WHERE text IS NOT NULL))"""


@query(
    "op1_benchmark_decontamination",
    f"""
    WITH b AS ({_window_sql("benchmark", "item_id", "[least(len(w), 5)]")}), widths AS (SELECT list(DISTINCT width) AS widths FROM b),
    d AS ({_window_sql("documents", "doc_id", "(SELECT widths FROM widths)")}),
    sizes AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id),
    hits AS (SELECT item_id, doc_id, count(*) AS shared FROM b JOIN d USING (width, shingle) GROUP BY item_id, doc_id)
    SELECT item_id, doc_id, n AS n_item_shingles, shared AS n_shared, shared / n AS containment
    FROM hits JOIN sizes USING (item_id) WHERE shared * 100 >= n * 75
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a test item and a document that holds it."""
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.token_digests(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op3_hilbert_shards")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot; the law is equal row counts."""
    placed = hilbert.shards(read(spark, sf_dir, "documents"))
    law = {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    return placed.withColumns(law).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "cell")


def _component_sql(table: str, key: str) -> str:
    """The least key reachable over the links (a, b), which hold both directions."""
    return f"""
    reach({key}, root) AS (SELECT {key}, {key} FROM {table} UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.{key}),
    roots AS (SELECT {key}, min(root) AS component_id FROM reach GROUP BY {key})"""


@query(
    "op4_minhash_near_dedup",
    f"""
    WITH RECURSIVE s AS ({_shingle_sql("documents", "doc_id")}),
    sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y USING (shingle)
              WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
              WHERE shared * 100 >= (p.n + q.n - shared) * 75),
    {_component_sql("documents", "doc_id")}
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM documents JOIN roots USING (doc_id) LEFT JOIN sizes USING (doc_id)
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    return minhash.near_duplicate_groups(read(spark, sf_dir, "documents"))


@query("op5_quality_cotraining")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by each view and by both."""
    return cotrain.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query(
    "op6_embedding_near_dedup",
    f"""
    WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
              WHERE len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93),
    n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
    {_component_sql("embeddings", "vec_id")}
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN roots USING (vec_id) LEFT JOIN n USING (vec_id)
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    return projection.near_duplicate_vectors(read(spark, sf_dir, "embeddings"))


@query(
    "op7_preference_format",
    """
    WITH t AS (SELECT conv_id AS pair_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
               FROM conversations WHERE conv_id IS NOT NULL),
    ends AS (SELECT pair_id, max((turn, role, text)) AS last FROM t GROUP BY pair_id),
    r AS (SELECT t.* FROM t JOIN ends USING (pair_id) WHERE t.turn < ends.last[1]
          UNION ALL
          SELECT e.pair_id, e.last[1], n.last[2], n.last[3] FROM ends e JOIN ends n ON n.pair_id = e.pair_id + 1),
    sides AS (SELECT pair_id, turn, role, text, max(c) AS c, max(r) AS r FROM (
                  SELECT *, 1 AS c, 0 AS r FROM t UNION ALL SELECT *, 0 AS c, 1 AS r FROM r)
              GROUP BY pair_id, turn, role, text),
    apart AS (SELECT pair_id, min(turn) AS apart FROM sides WHERE c <> r GROUP BY pair_id),
    parts AS (SELECT pair_id, turn, role, text, unnest(CASE WHEN apart IS NULL OR turn < apart THEN ['prompt']
                  WHEN c = 1 AND r = 1 THEN ['chosen', 'rejected'] WHEN c = 1 THEN ['chosen'] ELSE ['rejected'] END) AS part
              FROM sides LEFT JOIN apart USING (pair_id))
    SELECT pair_id, part, turn, role, '<|' || role || '|>' || chr(10) || text || chr(10) AS rendered,
           CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(role) + 5 ELSE 0 END AS train_from,
           CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(role) + 5 + length(text) ELSE 0 END AS train_to
    FROM parts
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with the ending of the next one."""
    return preference.preference_rows(*preference.swapped_endings(read(spark, sf_dir, "conversations")))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def _license_sql() -> str:
    """The same lookup and the same rules, one after the other."""
    known = ", ".join(f"('{sentence}', '{name}')" for sentence, name in licenses.lookup().items())
    steps = "s0 AS (SELECT doc_id, ids, list_aggregate(list_transform(ids, lambda i: '<' || i || '>'), 'string_agg', '') AS rest, '' AS found FROM found)"
    for n, (name, ids) in enumerate(licenses.RULES):
        take = "".join(f"<{i}>" for i in ids)
        steps += f""", s{n + 1} AS (SELECT doc_id, ids, replace(rest, '{take}', '|') AS rest,
            CASE WHEN contains(rest, '{take}') THEN found || ',{name}' ELSE found END AS found FROM s{n})"""
    most, lines = max(map(len, licenses.lookup())), max(k.count(" ") + 1 for k in licenses.lookup())
    # The first of equal licences in the order of the rules is kept.
    return rf"""
    WITH known(sentence, name) AS (VALUES {known}),
    marked AS (SELECT doc_id, regexp_replace(regexp_replace(lower(text), '{licenses.SENTENCE_END}', 'E', 'g'), '\r\n|\r|\n', 'L', 'g') AS t FROM documents),
    plain AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '[^a-z0-9EL]+', ' ', 'g'), ' ?([EL]) ?', '\1', 'g'), '[EL]{{2,}}', 'E', 'g') AS t FROM marked),
    sentences AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS n FROM (SELECT doc_id, string_split(t, 'E') AS s FROM plain)),
    lines AS (SELECT doc_id, n, list_filter(string_split(trim(sentence), 'L'), lambda x: x <> '') AS lines FROM sentences),
    begun AS (SELECT doc_id, n, lines, unnest(range(1, len(lines) + 1)) AS i FROM lines),
    runs AS (SELECT doc_id, n, i, j, array_to_string(lines[i:j], ' ') AS run FROM (
        SELECT *, unnest(range(i, least(len(lines), i + {lines - 1}) + 1)) AS j FROM begun) WHERE length(lines[i]) <= {most}),
    hits AS (SELECT doc_id, n, i, j, name FROM runs JOIN known ON run = sentence),
    counted AS (SELECT * FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits g WHERE g.doc_id = h.doc_id AND g.n = h.n
        AND g.i <= h.j AND g.j >= h.i AND (g.i < h.i OR (g.i = h.i AND g.j > h.j)))),
    found AS (SELECT doc_id, coalesce(list(name ORDER BY n, i) FILTER (name IS NOT NULL), []) AS ids
              FROM (SELECT doc_id FROM documents) LEFT JOIN counted USING (doc_id) GROUP BY doc_id),
    {steps}
    SELECT doc_id, len(ids) AS n_known, coalesce(array_to_string(ids, ','), '') AS identifiers,
        array_to_string(list_filter(string_split(coalesce(found, ''), ','), lambda x, i: x <> ''
            AND list_position(string_split(coalesce(found, ''), ','), x) = i), ',') AS licences,
        array_to_string(list_filter(string_split_regex(coalesce(rest, ''), '[<>|]+'), lambda x: x <> ''), ',') AS unmatched
    FROM s{len(licenses.RULES)}"""


@query("op9_license_scan", _license_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence sentences, licences and what no rule takes, of every document."""
    return licenses.scan(read(spark, sf_dir, "documents"))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    return tokencount.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _step_sql(state: str, cost: str, letter: str) -> str:
    """A path's cost in eight digits and its audit, one edit longer."""
    return f"lpad((left({state}, 8)::INT + {cost})::VARCHAR, 8, '0') || substr({state}, 9) || '{letter}'"


def _repair_sql() -> str:
    """Forward: for every state the cheapest, then least path so far, turn by turn; the repaired turns follow from the audit."""
    insert = {s: _step_sql(s, "3", "I") for s in ("v0", "v1", "v2", "v3")}
    twice = {s: _step_sql(s, "6", "II") for s in ("v0", "v1")}
    w2 = f"least(v2, {insert['v0']}, {insert['v1']}, {insert['v3']})"
    w3 = f"least(v3, {insert['v2']}, {twice['v0']}, {twice['v1']})"

    def edited(states: tuple[str, ...], initial: str) -> str:
        kept = ", ".join(f"CASE WHEN initial = '{initial}' AND NOT forced THEN {_step_sql(s, '3 * cut', 'K')} END" for s in states)
        changed = ", ".join(f"CASE WHEN NOT forced THEN {_step_sql(s, '3 + 3 * cut', 'R')} END" for s in states)
        return f"{kept}, {changed}"

    return rf"""
    WITH RECURSIVE tab AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS tab
                 FROM range(256) AS r(i)),
    k AS (SELECT coalesce(conv_id::VARCHAR, ' ') AS cid, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 list_reduce([ascii(x) FOR x IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')],
                     lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295) AS crc FROM conversations, tab),
    damaged AS (SELECT cid, turn, CASE WHEN b = 4 THEN 'user' ELSE role END AS role,
                       CASE WHEN b = 1 THEN '' WHEN b = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                       unnest(CASE WHEN b = 3 THEN [1, 2] ELSE [1] END) AS copy
                FROM (SELECT *, xor(crc, 4294967295) % 20 AS b FROM k) WHERE b <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged),
    t AS (SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
                 n > min(n) OVER (PARTITION BY cid, role, text) AS again,
                 NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open FROM placed),
    f AS (SELECT *, blank OR again AS forced, (open AND NOT blank AND NOT again)::INT AS cut,
                 lag(initial) OVER (PARTITION BY cid ORDER BY n) || initial AS pair FROM t),
    paths AS (SELECT DISTINCT cid, 0::BIGINT AS n, '00000000' AS v0, NULL::VARCHAR AS v1, NULL::VARCHAR AS v2, NULL::VARCHAR AS v3 FROM f
        UNION ALL
        SELECT cid, n, {_step_sql("v0", "4", "D")}, least({_step_sql("v1", "4", "D")}, CASE WHEN initial = 's' AND NOT forced THEN {_step_sql("v0", "3 * cut", "K")} END),
               least({_step_sql("w2", "4", "D")}, {edited(("v0", "v1", "w3"), "u")}), least({_step_sql("w3", "4", "D")}, {edited(("w2",), "a")})
        FROM (SELECT p.cid, f.n, f.initial, f.forced, f.cut, v0, v1, {w2} AS w2, {w3} AS w3 FROM paths p JOIN f ON f.cid = p.cid AND f.n = p.n + 1)),
    best AS (SELECT cid, left(path, 8)::BIGINT AS cost, substr(path, 9) AS audit
             FROM (SELECT cid, least(v0, {w3}) AS path FROM paths JOIN (SELECT cid, max(n) AS n FROM f GROUP BY cid) USING (cid, n))),
    letters AS (SELECT cid, i, audit[i] AS letter, length(replace(audit[:i], 'I', '')) AS n, length(replace(audit[:i], 'D', '')) AS e
                FROM best, unnest(range(1, length(audit) + 1)) AS r(i)),
    kept AS (SELECT l.cid, i, e, letter, role, CASE WHEN letter = 'I' THEN '' ELSE text END AS text,
                    max((e = 1 AND letter = 'K' AND initial = 's')::INT) OVER (PARTITION BY l.cid) AS s
             FROM letters l LEFT JOIN f ON f.cid = l.cid AND f.n = l.n WHERE letter <> 'D'),
    repaired AS (SELECT cid, string_agg(CASE WHEN letter = 'K' THEN role WHEN (e - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS text
                 FROM kept GROUP BY cid),
    counts AS (SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                      count(*) FILTER (again AND NOT blank) AS duplicate, sum(cut)::BIGINT AS truncated,
                      count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY cid)
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired.text, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, ' ') AS cid FROM conversations)
    LEFT JOIN counts USING (cid) LEFT JOIN best USING (cid) LEFT JOIN repaired USING (cid)"""


@query("op11_conversation_repair", _repair_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired turns of every damaged conversation."""
    return turnrepair.damage_report(read(spark, sf_dir, "conversations"))


def _spans_sql(kind: str, pattern: str, check: str = "true", own: str = "m") -> str:
    """doc_id, kind, start, stop of the matches of a pattern that pass a check; a span is the end of its match, `own` of it."""
    return rf"""
    SELECT doc_id, '{kind}' AS kind, stop - length({own}) AS start, stop
    FROM (SELECT doc_id, m, list_sum(list_transform(p[:i] || found[:i], lambda x: length(x))) AS stop
          FROM (SELECT doc_id, p, found, i, found[i] AS m
                FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}') AS found FROM d),
                     unnest(range(1, len(found) + 1)) AS r(i)))
    WHERE {check}"""


def _digits_sql(text: str = "m") -> str:
    return rf"regexp_replace({text}, '[^0-9]', '', 'g')"


_LUHN_SQL = f"""length({_digits_sql()}) BETWEEN 16 AND 19 AND list_sum(list_transform(string_split(reverse({_digits_sql()}), ''),
    lambda x, i: CASE WHEN i % 2 = 1 THEN x::INT ELSE (2 * x::INT) // 10 + (2 * x::INT) % 10 END)) % 10 = 0"""
_ACCOUNT_SQL = r"regexp_extract(m, '([0-9]([ -]?[0-9])+|[A-Z][A-Z][0-9][0-9]( ?[A-Z0-9])+)$')"
_IBAN_SQL = f"""list_reduce(list_transform(string_split(replace({_ACCOUNT_SQL}, ' ', '')[5:] || replace({_ACCOUNT_SQL}, ' ', '')[:4], ''),
    lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE c::INT END), lambda a, v: CASE WHEN v > 9 THEN a * 100 + v ELSE a * 10 + v END % 97, 0) = 1
    AND length(replace({_ACCOUNT_SQL}, ' ', '')) BETWEEN 15 AND 34"""
_CUES_SQL = "|".join(spelt for cue in pii.CUES for spelt in (cue, cue.capitalize(), cue.upper()))


@query(
    "op12_personal_data",
    rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    s AS ({_spans_sql("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")}
    UNION ALL {_spans_sql("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR try_cast(x AS DOUBLE) > 255)) = 0")}
    UNION ALL {_spans_sql("card", r"[0-9]([ -]?[0-9])+", _LUHN_SQL)}
    UNION ALL {_spans_sql("phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({_digits_sql()}) BETWEEN 8 AND 15")}
    UNION ALL {_spans_sql("address", r'(https?://|ftp://|ssh://)[A-Za-z0-9._%+-]+(:[^\x00-\x20@/"<>]*)?@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*|mailto:[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+')}
    UNION ALL {_spans_sql("account", rf"({_CUES_SQL})( no| number| nr)?[ .:#=]{{1,4}}([0-9]([ -]?[0-9])+|[A-Z][A-Z][0-9][0-9]( ?[A-Z0-9])+)",
                          f"CASE WHEN {_ACCOUNT_SQL} < 'A' THEN length({_digits_sql(_ACCOUNT_SQL)}) BETWEEN 6 AND 18 ELSE {_IBAN_SQL} END", _ACCOUNT_SQL)}),
    k AS (SELECT *, list_position(['email', 'ip', 'card', 'phone', 'address', 'account'], kind) AS place,
                 kind || ':' || start || ':' || stop AS span FROM s),
    l AS (SELECT doc_id, count(*) FILTER (place = 1) AS n_email, count(*) FILTER (place = 2) AS n_ip,
                 count(*) FILTER (place = 3) AS n_card, count(*) FILTER (place = 4) AS n_phone,
                 string_agg(span, ',' ORDER BY place, start) FILTER (place <= 4) AS base,
                 string_agg(span, ',' ORDER BY place, start) AS spans FROM k GROUP BY doc_id)
    SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
           coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN l USING (doc_id)
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts by base kind, digest of the base spans and all spans of every document."""
    return pii.span_digests(pii.find_personal_data(read(spark, sf_dir, "documents")))


@query(
    "op13_filter_audit",
    r"""
    WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    f AS (SELECT doc_id, part, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
              + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
              + 8 * regexp_matches(t, '[#$%&*|]')::INT
              + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask FROM d),
    l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
          FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
    x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
               WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    steps AS (SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS own,
                     list_sum([1 << (ascii(filter_order[i]) - 65) FOR i IN range(1, step + 1)])::INT AS done
              FROM orders, unnest(range(1, 6)) AS r(step)),
    parts AS (SELECT DISTINCT part FROM c)
    SELECT part, filter_order, step::INT AS step,
        sum(CASE WHEN mask & done = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN mask & done = own THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN mask & own > 0 AND mask & done <> own THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN mask & done = own THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN mask & done = own THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
        sum(CASE WHEN mask & own > 0 THEN n * 120 // bit_count(mask) ELSE 0 END)::BIGINT AS shapley
    FROM steps, c GROUP BY ALL
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of every step of every order of five filters, by language."""
    return filteraudit.filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
