"""The operators of this folder as queries over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmart.llm import balltree, bpe, conversations, lines, maglev, outliers, packing, quality, simhash, spelling, substrings
from callmart.llm import surrogates, toxicity
from callmart.llm.common import crc_fold, read_table
from callmart.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Keys the surrogates; a deployment passes its own secret.
DEMO_KEY = "demo-key"
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def register(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(configure(spark), folder)

    QUERIES[build.__name__] = run
    return build


@register
def op1_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return surrogates.replace_private(docs, DEMO_KEY).select("doc_id", "text", "n_entities")


@register
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(read_table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@register
def op3_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.judge(read_table(spark, folder, "documents"))


@register
def op4_shards(spark: SparkSession, folder: str) -> DataFrame:
    return maglev.assign(read_table(spark, folder, "documents").select("doc_id"), "doc_id", SHARDS)


@register
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    model = toxicity.train(docs, labels, crc_fold("doc_id", 5) != 0, required=True)
    return toxicity.score(docs, model).select(
        "doc_id", (crc_fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", F.size("offending").alias("n_offending")
    )


@register
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    model = quality.train(docs, labels, crc_fold("doc_id", 4) != 2)
    return quality.score(docs, model).select(
        "doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted"
    )


@register
def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "embeddings")
    return balltree.top_k(rows, "vec_id", "embedding", F.col("vec_id") % 50 == 0)


@register
def op10_substrings(spark: SparkSession, folder: str) -> DataFrame:
    done = substrings.remove_repeats(read_table(spark, folder, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@register
def op11_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.prefix_trie(read_table(spark, folder, "conversations"))


@register
def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(read_table(spark, folder, "documents"))


@register
def op13_lines(spark: SparkSession, folder: str) -> DataFrame:
    done = lines.drop_common_lines(read_table(spark, folder, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL["op9_topk"] = """
with vectors as (
    select vec_id, [floor(256 * cast(x as double)) for x in embedding] as v from embeddings
    where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
pairs as (
    select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
    from vectors q join vectors c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as place from pairs)
select query_id, cast(place as int) as rank, vec_id, score from ranked where place <= 5
"""

SQL["op10_substrings"] = r"""
with split as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
),
starts as (select doc_id, words, unnest(range(1, len(words) - 48)) as p from split where len(words) >= 50),
windows as (select doc_id, p, sha256(array_to_string(words[p : p + 49], ' ')) as passage from starts),
firsts as (select passage, min(doc_id) as first_id from windows group by passage),
repeats as (select doc_id, p from windows join firsts using (passage) where first_id < doc_id),
gone as (select distinct doc_id, place from (select doc_id, unnest(range(p, p + 50)) as place from repeats)),
placed as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from split),
kept as (
    select doc_id, count(*) as n, string_agg(word, ' ' order by place) as text
    from placed anti join gone using (doc_id, place) group by doc_id
)
select doc_id, len(words) as n_words, len(words) - coalesce(n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from split left join kept using (doc_id)
"""

# CRC-32 by its table: of i the remainder of eight steps, then a step for each byte.
_CRC_TABLE = """
crc_table as (
    select list(list_reduce(range(8), lambda v, k: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, i) order by i) as t
    from range(256) as r(i)
)
"""
_CRC = "xor(list_reduce({bytes}, lambda v, b: xor(v >> 8, t[(xor(v, b) & 255) + 1]), cast(4294967295 as bigint)), 4294967295)"

SQL["op11_prefixes"] = f"""
with {_CRC_TABLE},
raw as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
),
turns as (
    select conv_id, id, bytes, row_number() over (partition by conv_id order by turn nulls first, id) as pos
    from (select *, left(sha256(length(role) || ':' || role || text), 32) as id, strlen(text) as bytes from raw)
),
convs as (
    select c, c - c % 5 as base, {_CRC.format(bytes="list_transform(string_split(cast(c as varchar), ''), lambda x: cast(unicode(x) as bigint))")} % 9 as h
    from (select distinct conv_id as c from turns), crc_table
),
new as (
    select c, pos, id, bytes from convs join turns on conv_id = base and pos <= h
    union all
    select c, pos, id, bytes from convs join turns on conv_id = c and pos > h
),
members as (
    select c, row_number() over w as depth, string_agg(id, ',') over w as path, bytes from new window w as (partition by c order by pos)
    union all
    select c, 0, '', 0 from convs
),
ends as (
    select path, sha256(string_agg(cast(c as varchar), ',' order by c)) as ends
    from (select c, max_by(path, depth) as path from members group by c) group by path
),
nodes as (
    select depth, path, min(c) as conv_id, count(*) as n_convs, any_value(bytes) as bytes from members group by depth, path
),
parents as (
    select n.*, m.path as above from nodes n left join members m on m.c = n.conv_id and m.depth = n.depth - 1
),
children as (select above as path, count(*) as n_children from parents where above is not null group by above),
sized as (select p.*, coalesce(n_children, 0) as n_children from parents p left join children using (path)),
below as (
    select m.path, cast(count(*) filter (where u.n_children = 0) as bigint) as n_leaves, cast(sum((u.n_convs - 1) * u.bytes) as bigint) as saved
    from sized u join members m on m.c = u.conv_id and m.depth <= u.depth group by m.path
)
select s.conv_id, cast(s.depth as bigint) as depth, p.conv_id as parent_conv_id, s.n_convs, s.n_children, b.n_leaves,
    b.saved as saved_tokens, coalesce(ends, sha256('')) as ends_sha256
from sized s join below b using (path) left join nodes p on p.path = s.above left join ends e on e.path = s.path
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op12_spelling"] = f"""
with recursive {_CRC_TABLE},
runs as (
    select coalesce(cast(doc_id as varchar), '') as doc, {_LOWER.format("unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+'))")} as run from documents
),
counted as (select doc, run, count(*) as n, doc || ':' || run as whole from runs group by doc, run),
hashed as (
    select run, n, {_CRC.format(bytes="flatten(list_transform(string_split(whole, ''), lambda x: case when unicode(x) < 128 then [cast(unicode(x) as bigint)] else [195, unicode(x) - 64] end))")} as h
    from counted, crc_table
),
spelt as (
    select case when h % 31 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed
),
words as (select word, cast(sum(n) as bigint) as n from spelt where length(word) >= 7 group by word having sum(n) >= 2),
cut as (
    select word, n, p, left(word, p - 1) || substr(word, p + 1) as rest from (select *, unnest(range(1, length(word) + 1)) as p from words)
),
near as (
    select a.word, b.word as other, b.n from cut a join cut b on a.rest = b.rest and a.p = b.p and a.word <> b.word
    union
    select a.word, b.word, b.n from cut a join words b on a.rest = b.word
    union
    select b.word, a.word, a.n from cut a join words b on a.rest = b.word
),
best as (
    select word, count(*) as n_near, max(n) as best_n from near group by word
),
formed as (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when best_n >= 10 * w.n then best_n end as form_n from words w left join best using (word)
),
forms as (
    select f.word, f.n, f.n_near, f.form_n, min(other) as form
    from formed f left join near e on e.word = f.word and e.n = f.form_n group by all
),
chain as (
    select word, word as root, 0 as step from forms
    union all
    select c.word, f.form, step + 1 from chain c join forms f on f.word = c.root where f.form is not null
)
select f.word, f.form, r.root, f.n, f.n_near, f.form_n
from forms f join (select word, max_by(root, step) as root from chain group by word) r using (word)
"""

SQL["op13_lines"] = f"""
with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
placed as (select doc_id, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as place from split),
keyed as (
    select *, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from placed
),
common as (
    select key, max(doc_id) as holder from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
)
select doc_id, count(*) as n_lines, count(*) filter (where doc_id < holder) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by place) filter (where holder is null or doc_id = holder), '')) as kept_sha256
from keyed left join common using (key) group by doc_id
"""
