"""Registered queries of this subpackage, each an operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin_settings
from .bin_slack import pack
from .collocations import collocations
from .exact_dedup import dedup_classes
from .extendible import BITS, SHARD_BYTES, shard
from .line_quality import line_quality
from .ngram_join import ngram_join
from .positional_index import contaminated
from .prefix_trie import prefix_trie, regrown, turns_of
from .secret_scan import BASE, RULES, joined, new_ledger, scan_versions
from .source_mix import mix_sources
from .suffix_dedup import suffix_dedup
from .url_ratio import judge_urls
from .warc import archive_pages


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return pin_settings(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in each document, through a ledger that begins empty."""
    base = [r.kind for r in BASE]
    found = scan_versions(_table(spark, folder, "documents"), new_ledger(spark))
    count = lambda rule: F.size(F.filter("found", lambda x: x["rule"] == rule.name)).cast("long")
    return found.select(
        "doc_id",
        *[count(r).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(joined(F.col("found"), base), 256).alias("base_sha256"),
        joined(F.col("found"), [r.kind for r in RULES]).alias("spans"),
    )


def op2_url_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on each page's URL."""
    return judge_urls(_table(spark, folder, "pages"))


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's class of near copies and its number of links."""
    return ngram_join(_table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


def op4_warc_assembly(spark: SparkSession, folder: str) -> DataFrame:
    """Each page as its archive record has it."""
    return archive_pages(_table(spark, folder, "pages"), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each document without strings that smaller documents have."""
    return suffix_dedup(_table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), "kept_sha256"
    )


def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How many words the mix takes of each document, and where: (time, shard, place in the shard's order)."""
    taken = F.sum(F.when(F.col("shard").isNotNull(), F.col("size")).otherwise(0))
    shards = F.collect_list(F.when(F.col("shard").isNotNull(), F.struct("time", "shard", "place")))
    return (
        mix_sources(_table(spark, folder, "documents"))
        .groupBy("row", "doc_id", "size", "source_size", "target")
        .agg(taken.alias("taken"), F.sort_array(shards).alias("shards"))
        .drop("row")
    )


def op7_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Base facts and verdict of each document."""
    return line_quality(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words", "kept"
    )


def op8_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each document's pieces in packed sequences."""
    return pack(_table(spark, folder, "documents"))


def op9_extendible_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of each document."""
    return shard(_table(spark, folder, "documents")).drop("row")


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The copy that stays for each document."""
    return dedup_classes(_table(spark, folder, "documents")).drop("row")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of the trie of regrown conversations."""
    return prefix_trie(*regrown(turns_of(_table(spark, folder, "conversations"))))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of each language."""
    return collocations(_table(spark, folder, "documents"))


def op13_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in each document."""
    return contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark")).drop("row")


QUERIES = {
    "op1_secret_ledger": op1_secret_ledger,
    "op2_url_ratio": op2_url_ratio,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_warc_assembly": op4_warc_assembly,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_source_mix": op6_source_mix,
    "op7_line_quality": op7_line_quality,
    "op8_bin_slack": op8_bin_slack,
    "op9_extendible_sharding": op9_extendible_sharding,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_collocations": op12_collocations,
    "op13_positional_index": op13_positional_index,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

ORACLE = {
    "op9_extendible_sharding": f"""
        with own as (
            select doc_id, strlen(coalesce(text, ''))::bigint as bytes,
                   lpad(bin(('0x' || md5('=' || doc_id)[1:15])::bigint), {BITS}, '0') as bits
            from documents),
        levels as (select *, bits[1:depth] as shard from own, (select unnest(range({BITS} + 1))::int as depth)),
        buckets as (
            select depth, shard, sum(bytes)::bigint as shard_bytes, count(*) as shard_rows from levels group by all
            having sum(bytes) <= {SHARD_BYTES} or count(*) = 1)
        select doc_id, bytes, shard, depth, shard_bytes, shard_rows from levels join buckets using (depth, shard)
        qualify row_number() over (partition by doc_id order by depth) = 1""",
    "op10_exact_dedup": f"""
        select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
               row_number() over (partition by normal order by doc_id) = 1 as kept, sha256(normal) as text_sha256
        from (select doc_id, {_NORMAL} as normal from documents)
        window same as (partition by normal)""",
    "op11_prefix_trie": r"""
        with turns as (
            select conv_id as c, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                                      order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as own
            from conversations where conv_id is not null group by 1),
        drawn as (
            select *, xor(list_reduce(
                list_concat([4294967295::bigint], list_transform(string_split(c::varchar, ''), lambda x: ord(x)::bigint)),
                lambda seen, byte: list_reduce(list_concat([xor(seen, byte)], range(8)),
                    lambda v, bit: case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end)), 4294967295) % 4 as h
            from turns),
        regrown as (
            select d.c, list_concat(list_slice(coalesce(b.own, []), 1, h), list_slice(d.own, h + 1, len(d.own))) as s
            from drawn d left join turns b on b.c = d.c - d.c % 20),
        prefixes as (select c, d, s[1:d] as p, d = len(s) as ends from (select *, unnest(range(len(s) + 1)) as d from regrown)),
        nodes as (
            select p, d, min(c) as conv_id, count(*) as n_convs,
                   sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) as ends_sha256
            from prefixes group by p, d),
        children as (select p[1:d - 1] as p, count(*) as n_children from nodes where d > 0 group by 1),
        facts as (
            select n.*, coalesce(n_children, 0) as n_children, (n_children is null)::int as leaf,
                   case when d = 0 then 0
                        else (n_convs - 1) * len(regexp_extract_all(p[d].t, '[^\x20\x09-\x0D]+')) end as saved
            from nodes n left join children using (p)),
        sums as (
            select p[1:k] as p, sum(leaf)::bigint as n_leaves, sum(saved)::bigint as saved_tokens
            from (select *, unnest(range(d + 1)) as k from facts) group by 1)
        select f.conv_id, f.d as depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens,
               f.ends_sha256
        from facts f join sums using (p) left join nodes u on f.d > 0 and u.p = f.p[1:f.d - 1]""",
    "op12_collocations": rf"""
        with pieces as (
            select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
            from (select coalesce(lang, 'und') as lang,
                         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                                      '[.,;:!?\x0A-\x0D]')) as piece
                  from documents)),
        grams as (
            select lang, size, array_to_string(w[k:k + size - 1], ' ') as p, count(*) as f
            from (select lang, size, w, unnest(range(1, len(w) - size + 2)) as k from pieces, range(1, 5) as t(size))
            group by all),
        candidates as (select lang, size, p, f as a, string_split(p, ' ') as w from grams where size > 1 and f >= 30),
        covered as (
            select distinct s.lang, s.p from candidates s join candidates b
            on b.lang = s.lang and b.size > s.size and contains(' ' || b.p || ' ', ' ' || s.p || ' ') and 100 * b.a >= 80 * s.a),
        cuts as (
            select c.lang, c.p, a, k, x.f as l, y.f as r, ((2000000::hugeint * a) // (x.f + y.f))::bigint as score
            from (select *, unnest(range(1, size)) as k from candidates anti join covered using (lang, p)) c
            join grams x on x.lang = c.lang and x.p = array_to_string(c.w[1:k], ' ')
            join grams y on y.lang = c.lang and y.p = array_to_string(c.w[k + 1:], ' ')),
        scored as (select * from cuts qualify row_number() over (partition by lang, p order by score, k) = 1)
        select lang, row_number() over (partition by lang order by score desc, a desc, encode(p)) as rank, p as phrase, a, l, r,
               (select sum(f)::bigint from grams g where g.lang = s.lang and size = 1) as n, score
        from scored s qualify rank <= 2000""",
    "op13_positional_index": rf"""
        with texts as (
            select *, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from (select 'd' as kind, row_number() over () as r, doc_id as id, text from documents
                  union all select 'i', 0, item_id, text from benchmark where item_id is not null)),
        windows as (
            select distinct id::varchar as item, least(10, len(w)) as n, array_to_string(w[k:k + 9], ' ') as p
            from (select id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as k from texts where kind = 'i' and len(w) > 0)),
        places as (
            select r, n, k, array_to_string(w[k:k + n - 1], ' ') as p
            from (select r, w, n, unnest(range(1, len(w) - n + 2)) as k
                  from texts join (select distinct n from windows) on kind = 'd')),
        hits as (select r, k, n, item from places join windows using (p, n)),
        covered as (
            select r, count(distinct k) as n_hit from (select r, unnest(range(k, k + n)) as k from hits) group by r),
        found as (
            select r, count(distinct item) as n_items, sha256(string_agg(distinct item, ',' order by item)) as items_sha256
            from hits group by r)
        select id as doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               coalesce(items_sha256, sha256('')) as items_sha256, n_hit is not null as contaminated
        from texts left join covered using (r) left join found using (r) where kind = 'd'""",
}
