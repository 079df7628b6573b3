"""The operators as named queries over the test tables, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetfold.llm import equal_average as EA
from sheetfold.llm import filter_audit as FA
from sheetfold.llm import hash_forest as HF
from sheetfold.llm import language_id as LI
from sheetfold.llm import licenses as LC
from sheetfold.llm import merkle_text as MT
from sheetfold.llm import mixing as MX
from sheetfold.llm import near_dedup as ND
from sheetfold.llm import packing as PK
from sheetfold.llm import quality as QU
from sheetfold.llm import substring_dedup as SD
from sheetfold.llm import tier_packing as TP
from sheetfold.llm import warc_fixity as WF
from sheetfold.sources.fixtures import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


OP2_SQL = r"""
with recursive sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
ranked as (
  select source, sum(size)::bigint as source_size,
    (case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3 when 1 then 1 else 2 end)::bigint as weight
  from sized group by source),
fill as (
  select 0 as step, 1.5 * sum(source_size)::double as rest, sum(weight)::double as open_w from ranked
  union all
  select step + 1,
    1.5 * (select sum(source_size) from ranked)::double
      - 2.0 * coalesce((select sum(source_size) from ranked where weight * rest / open_w > 2.0 * source_size), 0)::double,
    coalesce((select sum(weight) from ranked where not weight * rest / open_w > 2.0 * source_size), 0)::double
  from fill where open_w > coalesce((select sum(weight) from ranked where not weight * rest / open_w > 2.0 * source_size), 0)),
targets as (
  select r.source, source_size, least(2.0 * source_size, weight * rest / open_w) as target
  from ranked r, (select rest, open_w from fill order by step desc limit 1)),
rated as (
  select s.doc_id, s.size, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
    ('0x' || substr(md5('17:' || coalesce(s.doc_id::varchar, 'null')), 1, 13))::bigint / 4503599627370496.0 as u
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target, rate, (floor(rate) + (u < rate - floor(rate))::int)::bigint as copies,
  (size * (floor(rate) + (u < rate - floor(rate))::int))::bigint as taken from rated
"""


@query("op2_mixing", OP2_SQL)
def op2_mixing(spark, sf):
    """Sources of ``documents`` mixed to weights 3, 1, 2 over 150% of all words: each document's words, target and words taken."""
    plan = MX.mix_plan(table(spark, sf, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "rate", "copies",
                       (F.col("size") * F.col("copies")).alias("taken"))


def _op3_sql() -> str:
    sha, short = "lambda p: sha256(p)", f"lambda p: substr(p, 1, {MT.DIGITS})"

    def tree(t):        # sections of paragraphs of leaves, then their nodes from below
        return f"""list_transform(string_split({t}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)),
      lambda p: list_transform(regexp_extract_all(p, '[^\\n]{{1,{MT.LEAF}}}'), {sha})))"""
    names = ("own", "edited", "next")
    trees = ", ".join(f"{tree(t)} as {n}_l" for n, t in zip(names, ("t", "e", "nt")))
    nodes = ", ".join(f"list_transform({n}_l, lambda s: list_transform(s, lambda p: sha256(array_to_string(p, '')))) as {n}_p" for n in names)
    sections = ", ".join(f"list_transform({n}_p, lambda s: sha256(array_to_string(s, ''))) as {n}_s" for n in names)
    roots = ", ".join(f"sha256(array_to_string({n}_s, '')) as {n}_root, "
                      f"list_distinct(list_transform(flatten(flatten({n}_l)), {short})) as {n}_leaves" for n in names)

    def text(n):
        paragraph = f"concat(substr({n}_p[i][j], 1, {MT.DIGITS}), list_aggregate(list_transform({n}_l[i][j], lambda x: '.' || substr(x, 1, {MT.DIGITS})), 'string_agg', ''))"
        return (f"{n}_root || ':' || array_to_string(list_transform(range(1, len({n}_p) + 1), lambda i: array_to_string("
                f"list_transform(range(1, len({n}_p[i]) + 1), lambda j: {paragraph}), ';')), '/')")

    def near(n):
        dice = f"2::double * len(list_intersect(own_leaves, {n}_leaves)) / (len(own_leaves) + len({n}_leaves))"
        return (f"case when own_root = {n}_root then 1::double when len(own_leaves) + len({n}_leaves) = 0 then 0::double "
                f"else least({dice}, 0.999999::double) end")
    differing = """array_to_string(flatten(list_transform(list_filter(range(1, greatest(len(own_s), len(edited_s)) + 1),
      lambda i: own_s[i] is distinct from edited_s[i]), lambda i: list_transform(list_filter(
      range(1, greatest(coalesce(len(own_p[i]), 0), coalesce(len(edited_p[i]), 0)) + 1), lambda j: own_p[i][j] is distinct from edited_p[i][j]),
      lambda j: (i - 1)::varchar || '.' || (j - 1)::varchar))), ',')"""
    return f"""
with paired as (
  select doc_id, t, coalesce(lead(t) over (order by doc_id desc), first_value(t) over (order by doc_id desc)) as nt
  from (select doc_id, coalesce(text, '') as t from documents)),
edited as (select *, substr(t, 1, length(t) - length(t) // 2) || substr(nt, 1, length(t) // 2) as e from paired),
leaved as (select doc_id, length(t) as n_chars, sha256(e) as edited_sha256, {trees} from edited),
noded as (select *, {nodes} from leaved),
sectioned as (select *, {sections} from noded),
rooted as (select *, {roots} from sectioned)
select doc_id, n_chars, edited_sha256, {text("own")} as fingerprint, {text("edited")} as edited_fingerprint,
  {near("edited")} as near_edited, {near("next")} as near_next, {differing} as edited_paragraphs
from rooted
"""


@query("op3_fingerprints", _op3_sql())
def op3_fingerprints(spark, sf):
    """Merkle fingerprints of every text and of its edited text, their likenesses, and the paragraphs
    (``section.paragraph``, from 0) that the descent of both trees finds edited."""
    t = MT.fingerprints(table(spark, sf, "documents"))
    edited = F.transform(MT.differing_paragraphs(F.col("tree"), F.col("edited_tree")),
                         lambda p: F.concat_ws(".", p["section"].cast("string"), p["paragraph"].cast("string")))
    return t.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
                    MT.serialised(F.col("tree")).alias("fingerprint"),
                    MT.serialised(F.col("edited_tree")).alias("edited_fingerprint"),
                    MT.likeness(F.col("tree"), F.col("edited_tree")).alias("near_edited"),
                    MT.likeness(F.col("tree"), F.col("next_tree")).alias("near_next"),
                    F.array_join(edited, ",").alias("edited_paragraphs"))


OP1_SQL = r"""
with recursive worded as (
  select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) as w
  from documents),
sets as (
  select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as shingle
  from worded),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
links as (
  select a.doc_id as a, b.doc_id as b from sets a join sets b on a.shingle = b.shingle and a.doc_id < b.doc_id
  join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id having 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))),
both_ways as (select a, b from links union all select b, a from links),
reach as (select distinct a as doc_id, a as other from both_ways union select r.doc_id, l.b from reach r join both_ways l on l.a = r.other),
least as (select doc_id, min(other) as component_id from reach group by doc_id)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, coalesce(l.component_id, d.doc_id) as component_id,
  coalesce(l.component_id, d.doc_id) = d.doc_id as kept
from documents d left join sizes s using (doc_id) left join least l using (doc_id)
"""


@query("op1_near_dedup", OP1_SQL)
def op1_near_dedup(spark, sf):
    """Near-duplicate groups of ``documents``: five-word shingles, similarity 0.75 and more."""
    return ND.near_groups(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op10_substring_dedup")
def op10_substring_dedup(spark, sf):
    """Spans of ``documents`` that occur earlier: each with its original offsets and the document that keeps it."""
    return SD.removed_spans(table(spark, sf, "documents"))


@query("op4_packing")
def op4_packing(spark, sf):
    """``documents`` as token pieces packed into sequences of at most 2048."""
    pieces = PK.token_pieces(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    # the digest of a piece's ids is all that the result keeps of them
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return PK.pack(digests).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


#: Pages of a stand-in archive; its records' offsets follow from their lengths in order of id.
PAGES_PER_ARCHIVE = 256


def page_replicas(spark, sf):
    """Stand-in replicas of archives of ``pages``: records with their offsets; in the second one the
    bytes of some records differ and some records are gone, at unchanged offsets."""
    pages = table(spark, sf, "pages")
    records = pages.select("page_id", F.floor(F.col("page_id") / PAGES_PER_ARCHIVE).cast("long").alias("archive"),
                           WF.warc_record(F.col("url"), F.col("html")).alias("record"))
    order = Window.partitionBy("archive").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length("record").cast("long")
    first = records.withColumn("offset", F.coalesce(F.sum(size).over(order), F.lit(0)).cast("long"))
    turn = F.conv(F.substring(F.md5(F.col("page_id").cast("string")), 1, 4), 16, 10).cast("long") % 100
    flipped = F.when(turn == 1, F.concat(F.lit(b"w"), F.substring("record", F.lit(2), F.octet_length("record")))).otherwise(F.col("record"))
    second = first.where(turn != 2).withColumn("record", flipped)
    return first.drop("page_id"), second.drop("page_id")


OP9_SQL = r"""
with records as (
  select page_id, page_id // 256 as archive,
    concat_ws(chr(13) || chr(10), 'WARC/1.1', 'WARC-Type: resource', 'WARC-Target-URI: ' || coalesce(url, ''), 'Content-Type: text/html',
      'Content-Length: ' || strlen(coalesce(html, '')), '', coalesce(html, ''), '', '') as record
  from pages),
placed as (
  select archive, record, strlen(record)::bigint as n,
    coalesce(sum(strlen(record)) over (partition by archive order by page_id rows between unbounded preceding and 1 preceding), 0)::bigint as "offset",
    ('0x' || substr(md5(page_id::varchar), 1, 4))::bigint % 100 as turn
  from records)
select archive, "offset", case turn when 1 then 'altered' else 'missing' end as status, n as first_length, sha256(record) as first_digest,
  case turn when 1 then n end as second_length, case turn when 1 then sha256('w' || substr(record, 2)) end as second_digest
from placed where turn in (1, 2)
"""


@query("op9_warc_fixity", OP9_SQL)
def op9_warc_fixity(spark, sf):
    """Merkle fixity audit of two replicas of the archives of ``pages``: the records that differ."""
    return WF.fixity_audit(*page_replicas(spark, sf))


@query("op6_language_id")
def op6_language_id(spark, sf):
    """The language of every text of ``documents``, learned from two thirds of them."""
    docs = table(spark, sf, "documents")
    model = LI.train(docs.where(~LI.held_out(F.col("doc_id"))))
    found = LI.identify(docs, model)
    return found.select("doc_id", LI.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op7_quality")
def op7_quality(spark, sf):
    """Co-trained quality scores of all ``documents``: by content, by metadata and by both."""
    docs = table(spark, sf, "documents")
    return QU.scores(docs, QU.train(docs, table(spark, sf, "labels")))


OP8_SQL = """
with usable as (
  select distinct vec_id, cast(embedding as double[]) as v from embeddings
  where vec_id is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (
  select q.vec_id as query_id, c.vec_id,
    sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) as score
  from usable q join usable c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
ranked as (select *, cast(row_number() over (partition by query_id order by score, vec_id) as integer) as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""


@query("op8_hash_forest", OP8_SQL)
def op8_hash_forest(spark, sf):
    """The ten nearest neighbours found of every hundredth vector of ``embeddings``."""
    return HF.nearest_neighbours(table(spark, sf, "embeddings"))


@query("op5_license_scan")
def op5_license_scan(spark, sf):
    """Licenses found in the texts of ``documents``, with coverage and place."""
    return LC.license_scan(table(spark, sf, "documents"))


def _op11_sql(rounds: int = EA.ROUNDS) -> str:
    def nearest(book):
        return f"""(select rid, part, min(d * 64 + entry) % 64 as entry, min(d * 64 + entry) // 64 as d from (
    select p.rid, p.part, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
    from parts p join {book} b on p.part = b.part) group by rid, part)"""

    steps = []
    for r in range(rounds):
        steps.append(f"""near{r} as {nearest(f'books{r}')},
means{r} as (select part, entry, list(((total - ((total % n) + n) % n) // n)::bigint order by pos) as x from (
    select c.part, a.entry, c.pos, sum(c.v)::bigint as total, count(*) as n from cells c join near{r} a on c.rid = a.rid and c.part = a.part
    group by c.part, a.entry, c.pos) group by part, entry),
books{r + 1} as (select b.part, b.entry, coalesce(m.x, b.x) as x from books{r} b left join means{r} m on b.part = m.part and b.entry = m.entry),""")
    return f"""
with kept as (
  select row_number() over (order by vec_id nulls last, embedding) as rid, vec_id, label, embedding from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
cells as (
  select rid, (j - 1) // (len(embedding) // 16) as part, (j - 1) % (len(embedding) // 16) as pos, floor(256 * embedding[j]::double)::bigint as v
  from (select rid, embedding, unnest(range(1, len(embedding) + 1)) as j from kept)),
parts as (select rid, part, list(v order by pos) as x from cells group by rid, part),
books0 as (select part, rid - 1 as entry, x from parts where rid <= 64),
""" + "\n".join(steps) + f"""
final as {nearest(f'books{rounds}')},
codes as (select rid, string_agg(printf('%02x', entry), '' order by part) as code, sum(d)::bigint as error from final group by rid),
digest as (select sha256(string_agg(v::varchar, ',' order by part, entry, pos)) as h
  from (select part, entry, unnest(range(len(x))) as pos, unnest(x) as v from books{rounds}))
select k.vec_id, c.code, c.error, (sum(c.error) over (partition by k.label))::bigint as label_error, (select h from digest) as codebooks_sha256
from kept k join codes c using (rid)
"""


@query("op11_equal_average", _op11_sql())
def op11_equal_average(spark, sf):
    """Codes, errors and codebooks' digest of all ``embeddings``: 16 parts, 64 entries, two rounds."""
    return EA.vector_codes(table(spark, sf, "embeddings"))


@query("op12_tier_packing")
def op12_tier_packing(spark, sf):
    """All ids of ``documents`` in sequences of 2048, 1024, 512 and 256, with their step groups."""
    packed = TP.tier_pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
                         "tier", "step_id")


OP13_SQL = r"""
with words as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
marks as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels where doc_id is not null group by doc_id),
firsts as (select t, min(doc_id) as first from words group by t),
failing as (
  select part, (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
    + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t))::int + 8 * regexp_matches(t, '[#$%&*|]')::int
    + 16 * coalesce(doc_id > first, false)::int as pattern, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
  from words join firsts using (t) left join marks using (doc_id)),
counts as (select part, pattern, count(*) as n, sum(good) as good, sum(toxic) as toxic from failing group by part, pattern),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f, unnest([1, 2, 4, 8, 16]) as bit),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from letters a, letters b, letters c, letters d, letters e where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps as (
  select filter_order, unnest([1, 2, 3, 4, 5])::int as step, unnest(bits) as bit,
    unnest([0, bits[1], bits[1] + bits[2], bits[1] + bits[2] + bits[3], 31 - bits[5]]) as before from orders),
audited as (
  select part, filter_order, step, bit,
    coalesce(sum(n) filter (pattern & (before + bit) = 0), 0)::bigint as kept,
    coalesce(sum(n) filter (pattern & before = 0 and pattern & bit > 0), 0)::bigint as removed,
    coalesce(sum(n) filter (pattern & before > 0 and pattern & bit > 0), 0)::bigint as redundant,
    coalesce(sum(n) filter (pattern = bit), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (pattern & before = 0 and pattern & bit > 0), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (pattern & before = 0 and pattern & bit > 0), 0)::bigint as toxic_lost
  from counts, steps group by part, filter_order, step, bit)
select * exclude (bit), sum(removed) over (partition by part, bit)::bigint as shapley from audited
"""


@query("op13_filter_audit", OP13_SQL)
def op13_filter_audit(spark, sf):
    """Five filters over ``documents`` in all 120 orders: what each step keeps, removes and loses, per source."""
    return FA.filter_audit(table(spark, sf, "documents"), table(spark, sf, "labels"))
