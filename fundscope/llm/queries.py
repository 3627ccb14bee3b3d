"""Registered queries of this package: the operators over their whole tables, in the columns of their contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscope.llm import ann, collocations, decontaminate, filter_audit, line_dedup, minhash, mixing, quality, simhash, substring_dedup, token_files, toxicity, url_filter

VOCABULARY = "word_bpe_49k.json"

# The rules of the URL query.
URL_RULES = (url_filter.Rule("net/", block=True), url_filter.Rule("example.net/en/", block=False),
             url_filter.Rule("example.com/de/", block=True), url_filter.Rule("org/fr/", block=False))

# The tree and target weights of the mixing query.
MIX_LEVELS = ("mix_domain", "lang", "source")
MIX_DOMAINS = 4
MIX_WEIGHTS = {
    ("domain0",): 4, ("domain1",): 3, ("domain2",): 2, ("domain3",): 1,
    **{(f"domain{d}", lang): w for d in range(MIX_DOMAINS) for lang, w in (("en", 5), ("de", 2), ("fr", 2), ("es", 1))},
}
MIX_SHARE = 0.6            # of the corpus' tokens

# The filters of the audit: a row fails where the condition holds; E is the filter against copies.
AUDIT_FILTERS = {
    "A": "n_words < 100", "B": "100 * n_distinct < 80 * n_words",
    "C": "100 * n_capitals > 10 * n_code_points", "D": "n_symbols > 0",
}
AUDIT_LOST = {"good_lost": "quality = 1", "toxic_lost": "toxic = 1"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(folds: int, fold: int):
    return F.crc32(F.col("doc_id").cast("string")) % folds == fold


def _digest(items: str):
    return F.sha2(F.concat_ws(",", items), 256)


def toxic_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learns from the labelled rows outside the held-out fold only."""
    return toxicity.fit(docs, labels.where(~_held_out(5, 0)).select("doc_id", F.col("toxic").alias("label")))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on the URLs that a rule decides."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    _, block = url_filter.longest_rule(url_filter.host(F.col("url")), url_filter.path(F.col("url")), URL_RULES)
    labelled = pages.select("url", block.cast("int").alias("label"))
    found = url_filter.judge(pages, URL_RULES, url_filter.fit(labelled))
    return found.select("page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"),
                        F.col("url_rule").alias("rule"), F.col("url_verdict").alias("verdict"),
                        F.col("url_score").alias("score"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    scored = toxicity.score(documents, toxic_model(documents, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", _held_out(5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(~_held_out(3, 1)).select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(documents, quality.fit(documents, labels))
    return scored.select("doc_id", _held_out(3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact matches by contract; ``n_near_items``: items with a window whose words all lie within one word of their places."""
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), slop=1)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        _digest("item_ids").alias("items_sha256"), "contaminated",
                        F.size("near_item_ids").cast("long").alias("n_near_items"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), 20, F.col("id") % 20 == 0)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deduped_lines(spark, sf_dir, line_dedup.MIN_LINES)


def op8_line_dedup_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every later copy of a run of lines goes, also of one or two lines."""
    return _deduped_lines(spark, sf_dir, 1)


def _deduped_lines(spark: SparkSession, sf_dir: str, min_lines: int) -> DataFrame:
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), min_lines=min_lines)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), "shared_depth")


def with_domain(docs: DataFrame) -> DataFrame:
    """A domain for each document: its source's number modulo four; null where the source has no number."""
    number = F.substring("source", 4, 9).try_cast("int")
    return docs.withColumn("mix_domain", F.concat(F.lit("domain"), (number % MIX_DOMAINS).cast("string")))


def mixed_documents(docs: DataFrame) -> DataFrame:
    return mixing.mix(with_domain(docs), MIX_LEVELS, F.col("all_tokens") * MIX_SHARE, weights=MIX_WEIGHTS)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixed_documents(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("mix_domain").alias("domain"), "lang", "source", F.col("mix_epoch").alias("epoch"),
                        F.col("mix_tokens").alias("n_tokens"))


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def encoded_documents(docs: DataFrame) -> DataFrame:
    manifest = token_files.write_sequences(docs, tokenizer_path())
    return token_files.read_sequences(manifest, docs.schema["doc_id"].dataType)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_documents(_table(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), AUDIT_FILTERS, repeats="E", part=F.col("lang"),
                              marks=_table(spark, sf_dir, "labels"), lost=AUDIT_LOST)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_decontamination": op5_decontamination,
    "op6_simhash": op6_simhash,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_line_dedup": op8_line_dedup,
    "op8_line_dedup_whole": op8_line_dedup_whole,
    "op9_mixing": op9_mixing,
    "op10_token_files": op10_token_files,
    "op11_minhash": op11_minhash,
    "op12_collocations": op12_collocations,
    "op13_filter_audit": op13_filter_audit,
}


def _mixing_sql() -> str:
    """The same budgets and cuts, level by level, without slices."""
    levels = ["domain", "lang", "source"]
    weight = {1: "case domain when 'domain0' then 4 when 'domain1' then 3 when 'domain2' then 2 else 1 end",
              2: "case when domain is null then 1 when lang = 'en' then 5 when lang in ('de', 'fr') then 2 else 1 end",
              3: "1"}
    parts = [r"""docs as (
        select doc_id, 'domain' || (try_cast(substr(source, 4, 9) as integer) % 4) as domain, lang, source,
               coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as n from documents)""",
             "leaves as (select domain, lang, source, sum(n) as tokens from docs group by all having sum(n) > 0)"]
    for d in (1, 2, 3):
        cols = ", ".join(levels[:d])
        up = ("(select floor(sum(tokens) * 0.6)::bigint as share from leaves) u on true" if d == 1 else
              f"s{d - 1} u on " + " and ".join(f"u.{c} is not distinct from k.{c}" for c in levels[:d - 1]))
        by = "partition by " + ", ".join(levels[:d - 1]) if d > 1 else ""
        order = f"{by} order by capacity::double / w::double, {levels[d - 1]} nulls first rows unbounded preceding"
        parts += [
            f"k{d} as (select {cols}, sum(tokens) * 3 as capacity, {weight[d]} as w from leaves group by {cols})",
            f"b{d} as (select k.*, u.share as budget from k{d} k join {up})",
            f"c{d} as (select *, sum(capacity) over ({order}) as cu, sum(w) over ({order}) as wu, sum(w) over ({by}) as aw from b{d})",
            f"f{d} as (select *, capacity * (aw - wu) <= (budget - cu) * w as is_full from c{d})",
            f"""g{d} as (select *, budget - coalesce(sum(case when is_full then capacity end) over ({by}), 0) as rest,
                sum(case when not is_full then w end) over ({by}) as ow from f{d})""",
            f"s{d} as (select {cols}, (case when is_full then capacity else rest * w // ow end)::bigint as share from g{d})",
        ]
    same = " and ".join(f"x.{c} is not distinct from y.{c}" for c in levels)
    parts += [
        f"""plan as (select x.*, (y.share // x.tokens)::bigint as whole, (y.share % x.tokens)::bigint as rest
             from leaves x join s3 y on {same})""",
        f"""rows as (select x.doc_id, x.domain, x.lang, x.source, x.n, y.whole, y.rest,
             md5('20:' || y.whole || ':' || x.doc_id) as mix_key from docs x join plan y on {same} where x.n > 0)""",
        """placed as (select *, sum(n) over (partition by domain, lang, source order by mix_key, doc_id::varchar
             rows unbounded preceding) - n as before from rows)""",
    ]
    return "with " + ",\n".join(parts) + """
        select doc_id, domain, lang, source, e::integer as epoch, n::bigint as n_tokens
        from (select *, unnest(range(0, whole)) as e from rows)
        union all
        select doc_id, domain, lang, source, whole::integer, least(n, rest - before)::bigint from placed where before < rest"""


def _line_dedup_sql(min_lines: int = 3, doublings: int = 20) -> str:
    """Line windows by concatenation: repeated ones beyond the first, and the largest power of two shared."""
    parts = ["""docs as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents)""",
             "c0 as (select doc_id, unnest(range(0, len(lines))) as pos, md5(unnest(lines)) as c from docs)"]
    for k in range(doublings):
        parts.append(f"""c{k + 1} as (select doc_id, pos, md5(c || f) as c from (
            select doc_id, pos, c, lead(c, {2 ** k}) over (partition by doc_id order by pos) as f from c{k}) where f is not null)""")
    shared = " union all ".join(f"select doc_id, {2 ** k} as depth from (select doc_id, count(*) over (partition by c) as n from c{k}) where n > 1"
                                for k in range(doublings + 1))
    window = " || ".join(["c", *(f"lead(c, {k}) over w" for k in range(1, min_lines))])
    parts += [
        f"depths as (select doc_id, max(depth) as depth from ({shared}) group by doc_id)",
        f"windows as (select doc_id, pos, md5({window}) as c from c0 window w as (partition by doc_id order by pos))",
        "later as (select doc_id, pos from (select doc_id, pos, row_number() over (partition by c order by doc_id, pos) as k from windows where c is not null) where k > 1)",
        f"gone as (select distinct doc_id, pos + unnest(range(0, {min_lines})) as pos from later)",
        """flat as (select c0.doc_id, c0.pos, gone.pos is not null as removed, unnest_line.line from c0
             join (select doc_id, unnest(range(0, len(lines))) as pos, unnest(lines) as line from docs) unnest_line using (doc_id, pos)
             left join gone using (doc_id, pos))""",
    ]
    return "with " + ",\n".join(parts) + """
        select doc_id, count(*) as n_lines, count(*) filter (removed) as n_removed,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not removed), '')) as kept_sha256,
               coalesce(any_value(depth), 0)::bigint as shared_depth
        from flat left join depths using (doc_id) group by doc_id"""


_AUDIT_SQL = r"""
with marks as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
docs as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
rows as (select part, doc_id,
           len(words) < 100 as a, 100 * len(list_distinct(words)) < 80 * len(words) as b,
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) as c,
           regexp_matches(text, '[#$%&*|]') as d, doc_id > min(doc_id) over (partition by text) as e from docs),
masks as (select part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * coalesce(e, false)::int as mask,
            coalesce(good, false) as good, coalesce(toxic, false) as toxic from rows left join marks using (doc_id)),
cells as (select part, mask, good, toxic, count(*) as n from masks group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f, unnest([1, 2, 4, 8, 16]) as bit),
orders as (select a.f || b.f || c.f || d.f || e.f as filter_order, a.bit as b1, b.bit as b2, c.bit as b3, d.bit as b4, e.bit as b5
           from letters a join letters b on b.f <> a.f join letters c on c.f not in (a.f, b.f)
           join letters d on d.f not in (a.f, b.f, c.f) join letters e on e.f not in (a.f, b.f, c.f, d.f)),
steps as (select filter_order, unnest([1, 2, 3, 4, 5]) as step, unnest([b1, b2, b3, b4, b5]) as bit,
            unnest([0, b1, b1 + b2, b1 + b2 + b3, b1 + b2 + b3 + b4]) as before from orders),
found as (select part, filter_order, step, bit,
    coalesce(sum(n) filter (mask & (before + bit) = 0), 0) as kept,
    coalesce(sum(n) filter (mask & before = 0 and mask & bit <> 0), 0) as removed,
    coalesce(sum(n) filter (mask & before <> 0 and mask & bit <> 0), 0) as redundant,
    coalesce(sum(n) filter (mask = bit), 0) as unique_fails,
    coalesce(sum(n) filter (mask & before = 0 and mask & bit <> 0 and good), 0) as good_lost,
    coalesce(sum(n) filter (mask & before = 0 and mask & bit <> 0 and toxic), 0) as toxic_lost
  from cells cross join steps group by all)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, bit))::bigint as shapley
from found"""


_COLLOCATIONS_SQL = r"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, sum(len(w)) as n from words group by lang),
grams as (select lang, k, w[i : i + k - 1] as p from (
      select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from (select lang, w, unnest([1, 2, 3, 4]) as k from words))),
f as (select lang, k, p, count(*) as a from grams group by all having count(*) >= 30),
inside as (select e.lang, e.p[i : i + j - 1] as p, max(e.a) as longer from (
      select lang, p, a, j, unnest(range(1, k - j + 2)) as i from (select lang, k, p, a, unnest(range(2, k)) as j from f where k > 2)) e group by all),
cuts as (select lang, p, a, k, unnest(range(1, k)) as c from f where k > 1),
scored as (select x.lang, x.p, x.a, x.c, l.a as l, r.a as r, 2000000::hugeint * x.a // (l.a + r.a) as score from cuts x
      join f l on l.lang = x.lang and l.p = x.p[1 : x.c] join f r on r.lang = x.lang and r.p = x.p[x.c + 1 : x.k]),
best as (select * from scored qualify row_number() over (partition by lang, p order by score, c) = 1),
named as (select b.lang, array_to_string(b.p, ' ') as phrase, b.a, b.l, b.r, b.score from best b
      left join inside on inside.lang = b.lang and inside.p = b.p where not coalesce(100 * longer >= 80 * a, false)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from named)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000"""


ORACLE_SQL: dict[str, str] = {"op12_collocations": _COLLOCATIONS_SQL, "op13_filter_audit": _AUDIT_SQL, "op8_line_dedup": _line_dedup_sql(),
                              "op8_line_dedup_whole": _line_dedup_sql(1), "op9_mixing": _mixing_sql()}
