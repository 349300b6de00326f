"""One query for each operator: its production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermart.llm import (
    conversation_trie, decontaminate, divergence, fingerprint, packing, pii, secret_scan, sharding, simhash, substring_dedup, toxicity, url_filter,
    warc,
)
from ledgermart.llm.common import read
from ledgermart.llm.registry import ORACLES, QUERIES, query  # noqa: F401


def _sql_text(pattern: str) -> str:
    return pattern.replace("'", "''")


_ASSIGN_SQL = _sql_text(secret_scan.ASSIGN)


@query("op1_simhash_dedup")
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op2_ordinal_toxicity")
def op2_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), grade="toxic")
    return toxicity.judge(docs, model)


_PARTS_LEFT = "value"
for _part in secret_scan.ALLOWED_PARTS:
    _PARTS_LEFT = f"regexp_replace({_PARTS_LEFT}, '{_part}', '!', 'g')"


@query(
    "op3_entropy_secrets",
    rf"""
    with shapes(kind, rank, shape) as (
        values ('assign', 0, '{_ASSIGN_SQL}'), ('access', 1, 'AKIA[A-Z0-9]{{16,}}'), ('hex', 2, '[0-9a-f]{{24,}}'),
               ('entropy', 3, '[A-Za-z0-9+/_=-]{{20,}}')
    ), parts as (
        select doc_id, kind, rank, shape, regexp_extract_all(coalesce(text, ''), shape) as own,
               string_split_regex(coalesce(text, ''), shape) as gaps
        from documents, shapes
    ), places as (
        select doc_id, kind, rank, shape, own[i] as value, gaps[i] as gap,
               (length(array_to_string(gaps[1:i], '')) + length(array_to_string(own[1:i - 1], '')))::bigint as begins
        from (select *, unnest(range(1, len(own) + 1)) as i from parts)
    ), spans as (
        select *, begins + length(value) as ends from places
        where kind <> 'assign' or length(regexp_extract(value, shape, 1)) >= 6
    ), edges as (
        select doc_id, s.begins as own, s.value, s.gap, b.begins as lo, b.ends as hi
        from spans s join spans b using (doc_id)
        where s.kind = 'entropy' and b.rank < 3 and b.begins < s.ends and s.begins < b.ends
        union all select doc_id, begins, value, gap, ends, ends from spans where kind = 'entropy'
    ), cuts as (
        select *, greatest(own, coalesce(max(hi) over (partition by doc_id, own order by lo, hi rows between unbounded preceding and 1 preceding), own)) as since
        from edges
    ), candidates as (
        select doc_id, since as begins, lo as ends, substr(value, (since - own + 1)::bigint, (lo - since)::bigint) as value,
               case when since = own then right(gap, 40) else '' end as ahead
        from cuts where lo - since >= 20
    ), pieces as (
        select doc_id, begins, ends, trim(unnest(string_split(replace(regexp_replace(
            ' ' || regexp_replace({_PARTS_LEFT}, '([!{secret_scan.SEPARATORS}])', ' \1 ', 'g') || ' ', '{secret_scan.WORD}', '!', 'g'), ' ', ''), '!')), '{secret_scan.SEPARATORS}') as piece
        from candidates
        where not regexp_matches(value, '{secret_scan.DOCUMENTED}') and not regexp_matches(ahead, '{_sql_text(secret_scan.ALLOWED_AFTER)}')
    ), windows as (
        select distinct doc_id, begins, ends, substr(piece, j, 20) as own
        from (select *, unnest(range(1, length(piece) - 18)) as j from pieces)
    ), counted as (
        select doc_id, begins, ends, own, sum(round(n * log2(n) * 1048576)) as total
        from (select *, count(*) as n from (select *, unnest(string_split(own, '')) as letter from windows) group by all)
        group by all
    ), random as (
        select distinct doc_id, begins, ends from counted
        where total <= round((20 * log2(20) - 20 * case when regexp_matches(own, '^([0-9a-f]+|[0-9A-F]+)$') then {secret_scan.HEX_BITS}
              when regexp_matches(own, '^[A-Za-z]+$') then {secret_scan.LETTER_BITS} else {secret_scan.MIXED_BITS} end) * 1048576)
    ), listed as (
        select doc_id, rank, kind, begins, kind || ':' || begins || ':' || ends as span from spans where rank < 3
        union all select doc_id, 3, 'entropy', begins, 'entropy:' || begins || ':' || ends from random
    )
    select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
           count(*) filter (kind = 'hex') as n_hex, count(*) filter (kind = 'entropy') as n_entropy,
           sha256(coalesce(string_agg(span, ',' order by begins, rank) filter (rank < 3), '')) as base_sha256,
           coalesce(string_agg(span, ',' order by begins, rank), '') as spans
    from documents left join listed using (doc_id)
    group by doc_id
    """,
)
def op3_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.scan(read(spark, sf_dir, "documents"))


@query("op4_weak_supervision_pii")
def op4_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.scan(read(spark, sf_dir, "documents"))


@query("op5_feistel_sharding")
def op5_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.assign(read(spark, sf_dir, "documents"))


#: The contract's rules: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query(
    "op7_url_rules",
    r"""
    with urls as (
        select page_id, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
               coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path
        from pages
    ), rules(rule_host, rule_path, verdict) as (
        values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
               ('net', '/es/', 'block'), ('net', '/fr/', 'block')
    ), judged as (
        select host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
               arg_max(verdict, length(rule_host || rule_path)) as verdict
        from (select distinct host, path from urls)
        join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
        group by all
    )
    select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
    from urls left join judged using (host, path)
    """,
)
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_filter.judge(read(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op8_complement_packing")
def op8_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document's pieces."""
    return packing.pack(read(spark, sf_dir, "documents"))


@query("op9_order_minhash")
def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint.with_neighbours(read(spark, sf_dir, "documents"))


@query(
    "op10_decontamination",
    r"""
    with texts as (
        select 'doc' as kind, doc_id as id, text from documents union all select 'item', item_id, text from benchmark
    ), worded as (
        select kind, id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
        from texts
    ), item_windows as (
        select distinct id as item_id, size, array_to_string(words[i:i + size - 1], ' ') as own
        from (select id, words, least(13, len(words)) as size, unnest(range(1, len(words) - least(13, len(words)) + 2)) as i
              from worded where kind = 'item' and len(words) > 0)
    ), doc_windows as (
        select id as doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') as own
        from (select id, words, size, unnest(range(1, len(words) - size + 2)) as i
              from worded, (select distinct size from item_windows) where kind = 'doc')
    ), found as (
        select doc_id, i, size, item_id from doc_windows join item_windows using (size, own)
    ), hits as (
        select doc_id, count(*) as n_hit
        from (select distinct doc_id, unnest(range(i, i + size)) as place from found) group by doc_id
    ), items as (
        select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
        from (select distinct doc_id, item_id::varchar as item_id from found) group by doc_id
    )
    select id as doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           sha256(coalesce(items, '')) as items_sha256,
           coalesce(n_hit > 0 and 20 * n_hit >= len(words), false) as contaminated
    from worded left join hits on hits.doc_id = id left join items on items.doc_id = id
    where kind = 'doc'
    """,
)
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document."""
    return decontaminate.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("longest_match")


@query(
    "op6_superkmer_dedup",
    r"""
    with docs as (
        select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
    ), windows as (
        select doc_id, i, array_to_string(words[i:i + 19], ' ') as own
        from (select doc_id, words, unnest(range(1, len(words) - 18)) as i from docs)
    ), later as (
        select doc_id, i from windows qualify row_number() over (partition by own order by doc_id, i) > 1
    ), gone as (
        select distinct doc_id, unnest(range(i, i + 20)) as place from later
    ), kept as (
        select doc_id, string_agg(word, ' ' order by place) as words, count(*) as n
        from (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as place from docs)
        anti join gone using (doc_id, place)
        group by doc_id
    )
    select doc_id, len(docs.words) as n_words, len(docs.words) - coalesce(n, 0) as n_removed,
           sha256(coalesce(kept.words, '')) as kept_sha256
    from docs left join kept using (doc_id)
    """,
)
def op6_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated windows of 20 words, removed from every document."""
    return substring_dedup.measure(read(spark, sf_dir, "documents"))


@query(
    "op13_source_divergence",
    r"""
    with docs as (
        select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as row_no,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words
        from documents
    ), places as (
        select lang, source, row_no, unnest(words) as term from docs
    ), kept as (
        select lang, term from (select distinct lang, row_no, term from places) group by all having count(*) >= 10
    ), found as (
        select lang, source, term, count(*) as n from places join kept using (lang, term) group by all
    ), groups as (
        select distinct lang, source from docs
    ), cells as (
        select lang, source, term, coalesce(n, 0) as n
        from groups join kept using (lang) left join found using (lang, source, term)
    ), likely as (
        select *, 1 + (1000000000::hugeint * (n + 2)) // (sum(n) over g + 2 * count(*) over g) as p
        from cells window g as (partition by lang, source)
    ), whole as (
        select *, 1 + (1000000000::hugeint * (n + 2)) // (sum(n) over g + 2 * count(*) over g) as q
        from (select lang, term, sum(n) as n from cells group by all) window g as (partition by lang)
    ), summed as (
        select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
        from likely a join likely b on a.lang = b.lang and a.term = b.term and a.source <> b.source
        group by all
    ), parts as (
        select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
        from groups a join groups b on a.lang = b.lang and a.source <> b.source
        left join summed s on s.lang = a.lang and s.source = a.source and s.item = b.source
        union all
        select l.lang, l.source, 'term', l.term, (p - q) * (p - q) // (p + q)
        from likely l join whole w on l.lang = w.lang and l.term = w.term
        where l.n > 0 and p > q
    )
    select lang, source, part, item, value::bigint as value,
           row_number() over (partition by lang, source, part order by value desc, item)::int as rank
    from parts
    qualify part = 'pair' or rank <= 10
    """,
)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language lie apart, and by which terms."""
    return divergence.audit(read(spark, sf_dir, "documents"))


@query(
    "op12_conversation_trie",
    """
    with own as (
        select conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} order by turn nulls first) as turns
        from conversations where conv_id is not null group by conv_id
    ), placed as (
        select conv_id, turns, conv_id - conv_id % 5 as base, xor(list_reduce(
                   list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
                   lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))),
                   4294967295) % 9 as h
        from own
    ), rebuilt as (
        select p.conv_id, list_concat(coalesce(b.turns[1:h], []), p.turns[h + 1:]) as turns
        from placed p left join own b on b.conv_id = p.base
    ), prefixes as (
        select conv_id, len(turns) as size, d, turns[1:d] as path from (select *, unnest(range(0, len(turns) + 1)) as d from rebuilt)
    ), nodes as (
        select d, path, min(conv_id) as conv_id, count(*) as n_convs,
               sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (size = d), '')) as ends_sha256
        from prefixes group by d, path
    ), edges as (
        select c.d, c.path, p.conv_id as parent_conv_id from nodes c join nodes p on c.d = p.d + 1 and c.path[1:p.d] = p.path
    ), kids as (
        select d - 1 as d, path[1:d - 1] as path, count(*) as n_children from nodes where d > 0 group by all
    ), known as (
        select n.*, parent_conv_id, coalesce(n_children, 0) as n_children
        from nodes n left join edges using (d, path) left join kids using (d, path)
    ), below as (
        select a.d, a.path, count(*) filter (b.n_children = 0) as n_leaves,
               sum((b.n_convs - 1) * case when b.d = 0 then 0 else strlen(b.path[-1].t) end) as saved_tokens
        from known a join known b on b.d >= a.d and b.path[1:a.d] = a.path
        group by all
    )
    select conv_id, d as depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::bigint as saved_tokens, ends_sha256
    from known join below using (d, path)
    """,
)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of the conversations, rebuilt as branches."""
    turns = read(spark, sf_dir, "conversations")
    return conversation_trie.trie(conversation_trie.branched(conversation_trie.paths_of(turns)))


@query(
    "op11_warc_transactions",
    """
    with digits as (
        select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
    ), firsts as (
        select html, min(page_id) as first from digits group by html
    )
    select page_id, strlen(html)::bigint as payload_bytes,
           array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(hex, 1 + 10 * (k // 8), 10))::bigint >> (35 - 5 * (k % 8))) & 31), 1)), '') as payload_digest,
           case when page_id = first then 'response' else 'revisit' end as record_type,
           case when page_id <> first then first end as refers_to
    from digits join firsts using (html)
    """,
)
def op11_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's capture, written to archives and put together again."""
    return warc.round_trip(read(spark, sf_dir, "pages"))
