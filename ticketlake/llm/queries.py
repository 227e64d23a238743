"""The operators over the given tables, with production parameters, and their oracle SQL where SQL can express them."""
from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm.common import sha256_of, table

#: Where the vocabulary files of public tokenizers lie on every worker.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op4_sentencepiece(spark, folder):
    """Number and digest of the piece ids of every document, and whether decoding restores its text."""
    from ticketlake.llm.sentencepiece_codec import round_trip

    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = round_trip(docs, tokenizer_file("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"),
        sha256_of(F.coalesce("piece_ids", F.array().cast("array<int>"))).alias("ids_sha256"), "exact",
    )


@query
def op5_token_counts(spark, folder):
    """Token count of every document."""
    from ticketlake.llm.token_counts import count_tokens

    return count_tokens(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op8_decontamination(spark, folder):
    """Words of every document that lie in a ten-word window of a benchmark item, and the items."""
    from ticketlake.llm.decontamination import matches, report

    found = report(matches(table(spark, folder, "documents"), table(spark, folder, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", sha256_of(F.col("items")).alias("items_sha256"), "contaminated")


ORACLES["op8_decontamination"] = r"""
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
bw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bp as (select item_id, w, least(len(w), 10) as n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from bw where len(w) > 0),
windows as (select distinct item_id, n, w[s:s + n - 1] as g from bp),
sizes as (select distinct n from windows),
dp as (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s from dw, sizes where len(w) >= n),
found as (select d.doc_id, d.s, d.n, x.item_id from dp d join windows x on x.n = d.n and x.g = d.w[d.s:d.s + d.n - 1]),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from found) group by doc_id),
items as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from found group by doc_id)
select dw.doc_id, len(dw.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join hit using (doc_id) left join items using (doc_id)
"""


@query
def op9_near_duplicates(spark, folder):
    """Components of near-duplicate documents."""
    from ticketlake.llm.near_duplicates import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


ORACLES["op9_near_duplicates"] = r"""
with recursive dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sh as (select doc_id, list_distinct([array_to_string(w[s:s + 4], ' ') for s in range(1, greatest(len(w) - 4, 1) + 1)]) as g from dw where len(w) > 0),
ids as (select doc_id, unnest(g) as x, len(g) as n from sh),
common as (select x from ids group by x having count(*) > 1),
b as (select ids.* from ids join common using (x)),
pairs as (select a.doc_id as u, c.doc_id as v, count(*) as i, any_value(a.n) as na, any_value(c.n) as nc from b a join b c on a.x = c.x and a.doc_id < c.doc_id group by a.doc_id, c.doc_id),
links as (select u, v from pairs where 100 * i >= 85 * (na + nc - i)),
sym as (select u, v from links union all select v, u from links),
reach(doc_id, r) as (select distinct u, u from sym union select b2.v, reach.r from reach join sym b2 on b2.u = reach.doc_id where reach.r < b2.v),
comp as (select doc_id, min(r) as c from reach group by doc_id)
select d.doc_id, coalesce(len(sh.g), 0)::bigint as n_shingles, least(coalesce(c, d.doc_id), d.doc_id) as component_id, least(coalesce(c, d.doc_id), d.doc_id) = d.doc_id as kept
from documents d left join sh using (doc_id) left join comp using (doc_id)
"""


@query
def op10_suffix_array(spark, folder):
    """Bytes of every document that a 100-byte string repeats from earlier on, and what is left."""
    from ticketlake.llm.suffix_array import remove_repeats

    found = remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_line_dedup(spark, folder):
    """Lines of every document, those in maximal repeated runs of fifty words or more, and what is left."""
    from ticketlake.llm.line_dedup import drop_repeated_lines

    found = drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: Common runs of each two texts, as far as they go: equal lines that stay the same number of lines apart.
#: What is left of every document, as a view `kept_lines (doc_id, n_lines, n_removed, n_runs, text)` over a view `{docs}`.
KEPT_LINES = r"""
ls as (select doc_id, text, string_split(text, chr(10)) as a from {docs}),
pos as (select doc_id, a, unnest(range(1, len(a) + 1)) as p from ls),
wc as (select doc_id, p, a[p] as line, len(regexp_extract_all(a[p], '[^\x20\x09-\x0D]+')) as n from pos),
same as (select x.doc_id as d, y.doc_id, y.p, y.p - x.p as shift, y.n from wc x join wc y on x.line = y.line and (x.doc_id < y.doc_id or (x.doc_id = y.doc_id and x.p < y.p))),
island as (select *, p - row_number() over (partition by d, doc_id, shift order by p) as i from same),
runs as (select doc_id, min(p) as p, max(p) as q from island group by d, doc_id, shift, i having sum(n) >= 50),
gone as (select distinct doc_id, unnest(range(p, q + 1)) as p from (select distinct * from runs)),
marked as (select wc.doc_id, wc.p, wc.line, gone.p is not null as cut, lag(gone.p is not null, 1, false) over (partition by wc.doc_id order by wc.p) as before from wc left join gone on gone.doc_id = wc.doc_id and gone.p = wc.p),
cut as (select doc_id, count(*) as n_lines, count(*) filter (cut) as n_removed, count(*) filter (cut and not before) as n_runs, coalesce(string_agg(line, chr(10) order by p) filter (not cut), '') as kept from marked group by doc_id),
kept_lines as (select d.doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_runs, 0)::bigint as n_runs, kept as text from {docs} d left join cut using (doc_id))
"""
ORACLES["op3_line_dedup"] = "with " + KEPT_LINES.format(docs="documents") + "select doc_id, n_lines, n_removed, n_runs, sha256(coalesce(text, '')) as kept_sha256 from kept_lines"


@query
def op2_url_rules(spark, folder):
    """Host, path, listed rule and verdict of every page."""
    from ticketlake.llm.url_rules import judge

    return judge(table(spark, folder, "pages"))


ORACLES["op2_url_rules"] = r"""
with recursive rest as (select page_id, url, case when strpos(url, '://') > 0 then url[strpos(url, '://') + 3:] end as r from pages),
parsed as (select page_id, url, coalesce(translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
  coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') as path from rest),
listed(verdict, rule, h, p) as (values ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'), ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
  ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
hits as (select distinct host, path, rule, verdict from parsed join listed on (host = h or suffix(host, '.' || h)) and prefix(path, p)),
known as (select host, path, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict from hits group by host, path),
cut as (select page_id, url, host, path, list_distinct(list_filter(list_concat(list_transform(string_split(host, '.'), lambda x: 'host:' || x), list_transform(string_split(path, '/'), lambda x: 'path:' || x),
  ['path:.' || regexp_extract(path, '\.([^./]*)$', 1)], list_transform(string_split(regexp_extract(coalesce(url, ''), '\?([^#]*)', 1), '&'), lambda x: 'query:' || x)),
  lambda x: not regexp_matches(x, '^(host|path|query):\.?$'))) as t from parsed),
lab as (select c.page_id, c.url, k.verdict, c.t from cut c join known k using (host, path)),
need as (select ceil(0.01::double * count(*)) as least from lab),
tok as (select row_number() over () as id, * from lab),
one as (select id, verdict, unnest(t) as a from tok),
freq as (select a from one group by a having count(*) >= (select least from need)),
f as (select one.* from one join freq using (a)),
sets as (select id, verdict, [a] as s from f union all select sets.id, sets.verdict, list_append(s, f.a) from sets join f on f.id = sets.id and f.a > s[-1]),
total as (select s, count(*) as total from sets group by s),
per as (select s, verdict, count(*) as support from sets group by s, verdict),
mined as (select s, verdict, support, support::double / total as confidence from per join total using (s) where support >= (select least from need) and support::double / total >= 0.8::double),
fits as (select c.url, m.*, row_number() over (partition by c.url order by confidence desc, support desc, len(s), array_to_string(s, ' '), m.verdict) as k
  from (select distinct url, t from cut left join known using (host, path) where known.rule is null and host <> '') c join mined m on list_has_all(c.t, m.s))
select c.page_id, c.host, c.path, known.rule, coalesce(known.verdict, fits.verdict, 'allow') as verdict,
  case when known.rule is null then array_to_string(fits.s, ' ') end as mined_rule
from cut c left join known using (host, path) left join fits on fits.url = c.url and fits.k = 1
"""


@query
def op6_toxicity(spark, folder):
    """Toxicity of every document; labels of the held-out fold are not read."""
    from ticketlake.llm.toxicity import fit, held_out, score

    docs = table(spark, folder, "documents")
    found = score(docs, fit(docs, table(spark, folder, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))


@query
def op1_lm_scoring(spark, folder):
    """Loss difference of every document between a model of the good documents and one of all documents."""
    from ticketlake.llm.lm_scoring import word_score

    good = table(spark, folder, "labels").filter("quality = 1")
    return word_score(table(spark, folder, "documents"), good).withColumn("loss_difference", F.round("loss_difference", 9))


@query
def op7_vector_duplicates(spark, folder):
    """Links and components of near-duplicate embeddings."""
    from ticketlake.llm.vector_duplicates import linked_vectors

    return linked_vectors(table(spark, folder, "embeddings"))


@query
def op11_importance_resampling(spark, folder):
    """Weight and score of every document against the benchmark, and its rank in the draw."""
    from ticketlake.llm.importance_resampling import resample

    drawn = resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


#: The CRC table follows from its rule; a word's CRC goes over its bytes, and only distinct words are hashed.
ORACLES["op11_importance_resampling"] = r"""
with steps as (select b, list_reduce(list_prepend(b::bigint, range(8)), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end) as t from (select unnest(range(256)) as b)),
tab as (select list(t order by b) as t from steps),
dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
bw as (select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as x from benchmark),
each as (select doc_id, unnest(w) as x from dw),
vocabulary as (select x, hex(encode(x)) as h from (select x from each union select x from bw)),
coded as (select x, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, len(h), 2), lambda i: ('0x' || h[i:i + 1])::bigint)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) % 10000 as bucket from vocabulary, tab),
source as (select bucket, count(*) as s from each join coded using (x) group by bucket),
target as (select bucket, count(*) as t from bw join coded using (x) group by bucket),
totals as (select (select count(*) from each)::double as sa, (select count(*) from bw)::double as ta),
gain as (select bucket, floor(1000 * ln((coalesce(t, 0)::double + 1) * (sa + 10000) / ((s::double + 1) * (ta + 10000))))::bigint as g from source left join target using (bucket), totals),
weights as (select doc_id, sum(g)::bigint as weight from each join coded using (x) join gain using (bucket) group by doc_id),
scored as (select doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
  coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from dw left join weights using (doc_id)),
placed as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_features >= 20)
select scored.*, case when place <= 10 * n // 100 then place end::bigint as rank from scored left join placed using (doc_id)
"""


@query
def op12_license_scans(spark, folder):
    """License phrases and notices in every document, as labels."""
    from ticketlake.llm.license_scans import report, scan_licenses

    return report(scan_licenses(table(spark, folder, "documents")))


def _license_oracle() -> str:
    """SQL over the fixed phrases and templates: every block's distinct template words, counted."""
    from ticketlake.llm.license_scans import PERCENT, PHRASES, TEMPLATES

    split = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    phrases = ", ".join(f"('{p}', '{label}')" for p, label in PHRASES)
    templates = ", ".join(f"({k}, '{label}', '{t}')" for k, (label, t) in enumerate(TEMPLATES))
    return rf"""
with dw as (select row_number() over () as r, doc_id, {split.format("text")} as w from documents),
phrases(p, label) as (values {phrases}),
said as (select r, label, unnest(range(0, len(w) - len(g) + 1)) as s, w, g from dw, (select label, string_split(p, ' ') as g from phrases)),
places as (select r, label, s from said where w[s + 1:s + len(g)] = g),
templates(k, label, t) as (values {templates}),
tw as (select k, label, {split.format("t")} as v from templates),
need as (select k, label, len(v) as m, len(list_distinct(v)) as size, ceil({PERCENT} * len(list_distinct(v)) / 100)::bigint as need from tw),
tokens as (select k, unnest(list_distinct(v)) as x from tw),
pos as (select r, len(w) as n, unnest(w) as x, unnest(range(0, len(w))) as p from dw),
met as (select r, n, k, p, coalesce(lag(p) over (partition by r, k, x order by p), -1) as prev from pos join tokens using (x)),
covered as (select r, k, unnest(range(greatest(p - m, prev, -1) + 1, least(p, greatest(n - m, 0)) + 1)) as s from met join need using (k)),
blocks as (select r, k, s, count(*) as there from covered group by r, k, s),
fits as (select r, label, max(there::double / size) as share from blocks join need using (k) where there >= need group by r, label),
base as (select r, count(*) as n_base, min(s) as first_word, max(s) as last_word, string_agg(distinct label, ',' order by label) as base_labels from places group by r),
every as (select r, string_agg(distinct label, ',' order by label) as labels, max(share) as share from (select r, label, share from fits union all select r, label, 1.0::double from places) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(share, 0)::double as score
from dw left join base using (r) left join every using (r)
"""


ORACLES["op12_license_scans"] = _license_oracle()


@query
def op13_phrase_mining(spark, folder):
    """The best phrases of two to four words of each language."""
    from ticketlake.llm.phrase_mining import mine_phrases

    return mine_phrases(table(spark, folder, "documents"))


ORACLES["op13_phrase_mining"] = r"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as t from documents),
ws as (select lang, regexp_extract_all(t, '[^\x20\x09]+') as w from pieces),
spots as (select lang, w, unnest(range(1, len(w) + 1)) as s from ws),
grams as (select lang, w[s:s + k - 1] as g, k, count(*) as f from spots, (select unnest([1, 2, 3, 4]) as k) where s + k - 1 <= len(w) group by lang, g, k),
cand as (select lang, g, k, f from grams where k > 1 and f >= 30),
cuts as (select c.lang, c.g, c.k, c.f as a, unnest(range(1, c.k)) as cut from cand c),
valued as (select cuts.lang, cuts.g, cuts.k, a, cut, x.f as l, y.f as r, 2000000::hugeint * a // (x.f + y.f) as score
  from cuts join grams x on x.lang = cuts.lang and x.g = cuts.g[1:cut] join grams y on y.lang = cuts.lang and y.g = cuts.g[cut + 1:]),
scored as (select *, row_number() over (partition by lang, g order by score, cut) as c from valued),
inner_ as (select lang, f, k, unnest(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: g[i:i + m - 1]))) as parts from cand where k > 2),
absorbed as (select distinct p.lang, p.g from (select lang, f, unnest(parts) as g from inner_) p join cand on cand.lang = p.lang and cand.g = p.g where 100 * p.f >= 80 * cand.f),
kept as (select lang, array_to_string(g, ' ') as phrase, a, l, r, score::bigint as score from scored where c = 1 and not exists (select 1 from absorbed where absorbed.lang = scored.lang and absorbed.g = scored.g)),
total as (select lang, sum(f)::bigint as n from grams where k = 1 group by lang),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join total using (lang) where rank <= 2000
"""
