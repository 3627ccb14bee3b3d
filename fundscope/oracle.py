"""Independent DuckDB SQL for every SQL-checkable query key.

Each entry is a complete statement over the driver's views (``lineitem``,
``orders``, ``documents`` ...).  The fixture views of ``FIXTURES.md`` part C
are spelled out as CTEs, so nothing here depends on the Spark code.
Column names and types are aliased to match the Spark output exactly.
"""

from __future__ import annotations

# C1: raw campaigns, typed as the Spark CSV scan infers them.
CAMPAIGNS = """
campaigns as (
  select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as project_id,
         p_name as name,
         p_type as "desc",
         nullif(p_brand, 'Brand#2') as keywords,
         case when l_linenumber = 6 and l_returnflag = 'A' then 'n/a'
              else cast(cast(round(cast(l_extendedprice as decimal(15,2))
                                  * cast(l_discount as decimal(15,2)), 2) as decimal(18,2)) as varchar)
         end as goal,
         case when o_orderstatus = 'O' then true end as disable_communication,
         nullif(o_orderstatus, 'P') as country,
         case when o_orderstatus = 'P' then 'N' || cast(n_nationkey as varchar)
              else substr(c_mktsegment, 1, 3) end as currency,
         cast(epoch(l_shipdate) as integer) as deadline,
         cast(epoch(l_shipdate) + 18 as integer) as state_changed_at,
         cast(case when l_linenumber <> 7
                   then epoch(o_orderdate) - 3600 * (cast(trunc(l_quantity) as integer) - 5)
              end as integer) as created_at,
         cast(epoch(o_orderdate) as integer) as launched_at,
         l_linenumber as backers_count,
         case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as final_status
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join part on l_partkey = p_partkey
)"""

# Tolerant int cast of the seven numeric columns (text -> double -> truncated int).
CASTED = """
casted as (
  select * replace (
    try_cast(trunc(try_cast(goal as double)) as integer) as goal,
    try_cast(trunc(try_cast(deadline as double)) as integer) as deadline,
    try_cast(trunc(try_cast(state_changed_at as double)) as integer) as state_changed_at,
    try_cast(trunc(try_cast(created_at as double)) as integer) as created_at,
    try_cast(trunc(try_cast(launched_at as double)) as integer) as launched_at,
    try_cast(trunc(try_cast(backers_count as double)) as integer) as backers_count,
    try_cast(trunc(try_cast(final_status as double)) as integer) as final_status)
  from campaigns
)"""


def _epoch_text(col: str) -> str:
    return f"strftime(make_timestamp(cast({col} as bigint) * 1000000), '%Y-%m-%d %H:%M:%S')"


# Common job up to the text column, no row filter yet.
FEATURES = f"""
feats as (
  select project_id,
         lower(name) as name,
         lower("desc") as "desc",
         goal,
         lower(keywords) as keywords,
         final_status,
         coalesce(country, currency) as country2,
         case when length(currency) = 3 then currency end as currency2,
         {_epoch_text('deadline')} as deadline2,
         {_epoch_text('created_at')} as created_at2,
         {_epoch_text('launched_at')} as launched_at2,
         cast(floor(deadline / 86400) - floor(launched_at / 86400) as integer) as days_campaign,
         round((cast(launched_at as bigint) - cast(created_at as bigint)) / 3600.0, 3) as hours_prepa,
         concat_ws(' ', lower(name), lower("desc"), lower(keywords)) as text
  from casted
)"""

PREPARED = """
prepared as (
  select project_id, name, "desc", goal, keywords, final_status, country2, currency2,
         deadline2, created_at2, launched_at2,
         coalesce(days_campaign, -1) as days_campaign,
         coalesce(hours_prepa, -1) as hours_prepa,
         text
  from feats
  where hours_prepa >= 0 and days_campaign >= 0 and goal > 0 and final_status in (0, 1)
)"""

ELAPSED = """
elapsed as (
  select project_id, name, "desc", coalesce(goal, -1) as goal, keywords, country, currency,
         final_status,
         coalesce(country, currency) as country2,
         case when length(currency) = 3 then currency end as currency2,
         coalesce(cast((cast(deadline as bigint) - cast(launched_at as bigint)) // 86400 as integer), -1)
           as days_campaign,
         coalesce(cast((cast(launched_at as bigint) - cast(created_at as bigint)) // 3600 as double), -1.0)
           as hours_prepa,
         concat_ws(' ', coalesce(name, 'null'), coalesce("desc", 'null'), coalesce(keywords, 'null')) as text
  from (select distinct * from casted where final_status = 0 or final_status = 1)
  where goal > 0
)"""

QUOTED_LINES = """
quoted_lines as (
  select p_partkey as line_id,
         p_name || '\"\"\"' || p_type || '\"\"' || p_brand || '\"' || cast(p_size as varchar) as value
  from part
)"""

QUOTED_COLUMNS = """
quoted_columns as (
  select p_partkey as line_id,
         p_name || '\"\"' || p_brand as name,
         p_type || '\"\"\"' || cast(p_size as varchar) || '\"' as "desc"
  from part
)"""

LINES = r"""
lines as (
  select doc_id, unnest(string_split_regex(text, '\r\n|\r|\n')) as value from documents
)"""

WORDS = """
words as (
  select doc_id,
         unnest(case when value = '' then ['']
                     when rtrim(value, ' ') = '' then []::varchar[]
                     else string_split(rtrim(value, ' '), ' ') end) as word
  from lines
)"""


def with_(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


_C = with_(CAMPAIGNS)
_CC = with_(CAMPAIGNS, CASTED)
_CF = with_(CAMPAIGNS, CASTED, FEATURES)
_CP = with_(CAMPAIGNS, CASTED, FEATURES, PREPARED)
_CE = with_(CAMPAIGNS, CASTED, ELAPSED)

# Columns of the feature view in the order of the job.
FEATURE_ORDER = """project_id, name, "desc", keywords, goal, final_status, country2, currency2,
      deadline2, created_at2, launched_at2, days_campaign, hours_prepa, text"""

SPARK_TYPE = """case data_type
      when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double'
      when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz'
      when 'BOOLEAN' then 'boolean' else lower(data_type) end"""

PREPARED_SELECT = _CP + "select * from prepared"

SQL: dict[str, str] = {
    # ------------------------------------------------------------ sources
    "csv_scan": _C + "select * from campaigns",
    "csv_scan_headerless": with_(QUOTED_LINES)
    + "select regexp_replace(value, '\"{2,}', ' ', 'g') as _c0 from quoted_lines",
    "text_scan": r"select unnest(string_split_regex(text, '\r\n|\r|\n')) as value from documents",
    "parquet_scan": "select * from lineitem",
    # ------------------------------------------------------------ sinks
    "parquet_sink": PREPARED_SELECT,
    "parquet_sink_strict": _CE + "select * from elapsed",
    "text_sink": with_(QUOTED_LINES)
    + "select regexp_replace(value, '\"{2,}', ' ', 'g') as value from quoted_lines",
    "csv_sink_delimited": PREPARED_SELECT,
    # ------------------------------------------------------------ profiling
    "row_count": "select count(*) as row_count from lineitem",
    "schema_profile": "select ordinal, column_name, data_type, non_null from ("
    + " select cast(ordinal_position as integer) as ordinal, column_name, "
    + SPARK_TYPE + " as data_type, column_name as c from information_schema.columns"
    + " where table_name = 'lineitem') s join (select * from (unpivot (select"
    + " count(l_orderkey) as l_orderkey, count(l_partkey) as l_partkey,"
    + " count(l_suppkey) as l_suppkey, count(l_linenumber) as l_linenumber,"
    + " count(l_quantity) as l_quantity, count(l_extendedprice) as l_extendedprice,"
    + " count(l_discount) as l_discount, count(l_tax) as l_tax,"
    + " count(l_returnflag) as l_returnflag, count(l_linestatus) as l_linestatus,"
    + " count(l_shipdate) as l_shipdate from lineitem) on columns(*) into name c value non_null)) n"
    + " using (c)",
    "head_n": "select * from orders order by o_orderkey limit 20",
    "describe_numeric": _CC + """
      select 'count' as summary, cast(count(goal) as double) as goal,
             cast(count(backers_count) as double) as backers_count,
             cast(count(final_status) as double) as final_status from casted
      union all select 'mean', round(avg(goal), 4), round(avg(backers_count), 4),
             round(avg(final_status), 4) from casted
      union all select 'stddev', round(stddev_samp(goal), 4), round(stddev_samp(backers_count), 4),
             round(stddev_samp(final_status), 4) from casted
      union all select 'min', min(goal), min(backers_count), min(final_status) from casted
      union all select 'max', max(goal), max(backers_count), max(final_status) from casted""",
    "describe_mixed": _C + """
      select 'count' as summary, cast(count(name) as varchar) as name,
             cast(count("desc") as varchar) as "desc", cast(count(keywords) as varchar) as keywords,
             cast(count(country) as varchar) as country, cast(count(currency) as varchar) as currency
      from campaigns
      union all select 'mean', cast(avg(try_cast(name as double)) as varchar),
             cast(avg(try_cast("desc" as double)) as varchar), cast(avg(try_cast(keywords as double)) as varchar),
             cast(avg(try_cast(country as double)) as varchar), cast(avg(try_cast(currency as double)) as varchar)
      from campaigns
      union all select 'stddev', cast(stddev_samp(try_cast(name as double)) as varchar),
             cast(stddev_samp(try_cast("desc" as double)) as varchar),
             cast(stddev_samp(try_cast(keywords as double)) as varchar),
             cast(stddev_samp(try_cast(country as double)) as varchar),
             cast(stddev_samp(try_cast(currency as double)) as varchar) from campaigns
      union all select 'min', min(name), min("desc"), min(keywords), min(country), min(currency) from campaigns
      union all select 'max', max(name), max("desc"), max(keywords), max(country), max(currency) from campaigns""",
    "value_counts": _CC + "select country, count(*) as count from casted group by country",
    "value_counts_pair": _CC + "select country, currency, count(*) as count from casted group by all",
    "value_counts_where_null": _CC
    + "select currency, count(*) as count from casted where country is null group by currency",
    "class_balance": _CC + "select final_status, count(*) as count from casted group by final_status",
    "top_k": _CC + """select state_changed_at, count(*) as count from casted group by state_changed_at
      order by count desc, state_changed_at asc nulls first limit 100""",
    "distinct_values": _CC + "select distinct deadline from casted",
    # ------------------------------------------------------------ columns
    "cast_ints": _CC + "select * from casted",
    "project": _CC + "select goal, final_status from casted",
    "drop_columns": _CC + "select * exclude (disable_communication) from casted",
    "drop_leakage": _CC
    + "select * exclude (disable_communication, backers_count, state_changed_at) from casted",
    # ------------------------------------------------------------ filters
    "filter_durations": _CF + f"select {FEATURE_ORDER} from feats where hours_prepa >= 0 and days_campaign >= 0",
    "filter_goal": _CC + "select * from casted where goal > 0",
    "filter_classes": _CC + "select * from casted where final_status in (0, 1)",
    "filter_sql_predicate": _CC + "select * from casted where final_status = 0 or final_status = 1",
    "null_fill": _CF + f"""select {FEATURE_ORDER} from (
      select * replace (coalesce(goal, -1) as goal,
        coalesce(days_campaign, -1) as days_campaign, coalesce(hours_prepa, -1) as hours_prepa)
      from feats)""",
    "drop_duplicates": "select distinct l_returnflag, l_linestatus, l_quantity from lineitem",
    # ------------------------------------------------------------ scalar functions
    "repair_country": _C
    + "select project_id, country, currency, coalesce(country, currency) as country2 from campaigns",
    "validate_currency": _C + """select project_id, currency,
      case when length(currency) = 3 then currency end as currency2 from campaigns""",
    "lower_text": _C + """select project_id, lower(name) as name, lower("desc") as "desc",
      lower(keywords) as keywords from campaigns""",
    "clean_quote_runs": with_(QUOTED_LINES)
    + "select line_id, regexp_replace(value, '\"{2,}', ' ', 'g') as replaced from quoted_lines",
    "clean_quote_runs_columns": with_(QUOTED_COLUMNS) + """select line_id,
      regexp_replace(name, '\"{2,}', ' ', 'g') as name,
      regexp_replace("desc", '\"{2,}', ' ', 'g') as "desc" from quoted_columns""",
    "epoch_to_text": _CC + f"""select project_id, {_epoch_text('deadline')} as deadline2,
      {_epoch_text('created_at')} as created_at2, {_epoch_text('launched_at')} as launched_at2
      from casted""",
    "campaign_days": _CF + "select project_id, days_campaign from feats",
    "prep_hours": _CF + "select project_id, hours_prepa from feats",
    "campaign_days_elapsed": _CC + """select project_id,
      coalesce(cast((cast(deadline as bigint) - cast(launched_at as bigint)) // 86400 as integer), -1)
        as days_campaign from casted""",
    "prep_hours_elapsed": _CC + """select project_id,
      coalesce(cast((cast(launched_at as bigint) - cast(created_at as bigint)) // 3600 as double), -1.0)
        as hours_prepa from casted""",
    "concat_text": _C + """select project_id, concat_ws(' ', name, "desc", keywords) as text
      from campaigns""",
    "concat_text_null_literal": _C + """select project_id,
      concat_ws(' ', coalesce(name, 'null'), coalesce("desc", 'null'), coalesce(keywords, 'null')) as text
      from campaigns""",
    "sentinel_to_null": _C + """select project_id, keywords, country,
      case when disable_communication then 'true' end as disable_communication,
      cast(created_at as varchar) as created_at from campaigns""",
    "null_or_zero_to_sentinel": _CC + """select project_id,
      case when coalesce(cast(goal as double), 0) = 0 then -1.0 else cast(goal as double) end as goal
      from casted""",
    # ------------------------------------------------------------ word count, jobs
    "split_words": with_(LINES, WORDS) + "select doc_id, word from words",
    "word_count": with_(LINES, WORDS) + "select word, count(*) as count from words group by word",
    "text_clean_roundtrip": with_(QUOTED_LINES)
    + "select regexp_replace(value, '\"{2,}', ' ', 'g') as _c0 from quoted_lines",
    "prepare_campaigns": PREPARED_SELECT,
    "prepare_campaigns_elapsed": _CE + "select * from elapsed",
}


# ---------------------------------------------------------------- text features

def _sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _stop_words_sql() -> str:
    from fundscope.functions.stopwords import default_stop_words
    return _sql_list(default_stop_words())


TEXT_MIN_DF = 5

TOKS = r"""
toks as (
  select doc_id, list_filter(regexp_split_to_array(lower(text), '\W+'), lambda x: length(x) >= 1)
         as tokens
  from src
)"""

FILT = """
filt as (
  select doc_id, list_filter(tokens, lambda x: lower(x) not in ({sw})) as filtered from toks
)"""

TF = """
tf as (
  select doc_id, term, count(*) as tf
  from (select doc_id, unnest(filtered) as term from filt) group by doc_id, term
)"""

VOCAB = """
vocab as (
  select term, count(*) as doc_freq, cast(sum(tf) as bigint) as term_count
  from tf group by term having count(*) >= {min_df}
)"""

IDF = """
idf as (
  select term, doc_freq,
         ln(((select count(*) from src) + 1.0) / (doc_freq + 1.0)) as idf
  from vocab
)"""

SRC_DOCS = "src as (select doc_id, text from documents)"
LABELLED = """
src as (
  select doc_id, text, lang as country2, source as currency2, cast(n_chars as integer) as goal,
         cast(length(split_part(text, chr(10), 1)) as integer) as days_campaign,
         n_chars / 3600.0 as hours_prepa, quality as final_status
  from documents join labels using (doc_id)
)"""

RULE = """
rule as (
  select doc_id, final_status, (doc_id % 97) / 96.0 as p1,
         case when ((doc_id % 97) / 96.0) / 0.3 > (1 - (doc_id % 97) / 96.0) / 0.7
              then 1.0::double else 0.0::double end as predictions
  from src
)"""


def _text_sql() -> dict[str, str]:
    sw = _stop_words_sql()
    filt = FILT.format(sw=sw)
    vocab = VOCAB.format(min_df=TEXT_MIN_DF)
    base = with_(SRC_DOCS, TOKS, filt, TF)
    vocab_q = with_(SRC_DOCS, TOKS, filt, TF, vocab)
    idf_q = with_(SRC_DOCS, TOKS, filt, TF, vocab, IDF)
    capped = """
capped as (
  select term from (select term, count(*) as doc_freq, sum(tf) as term_count from tf group by term)
  order by term_count desc, term asc limit 50
)"""
    labels_rank = """
lab as (
  select {c} as v, cast(row_number() over (order by count(*) desc, {c} asc) - 1 as double) as idx
  from {t} where {c} is not null group by {c}
)"""
    prepared_lab = labels_rank.format(c="currency2", t="prepared")
    source_lab = labels_rank.format(c="source", t="documents")
    lab_vocab = VOCAB.format(min_df=TEXT_MIN_DF)
    lab_c = labels_rank.format(c="country2", t="src").replace("lab as", "lab_c as")
    lab_u = labels_rank.format(c="currency2", t="src").replace("lab as", "lab_u as")
    return {
        "regex_tokenize": with_(SRC_DOCS, TOKS) + """select doc_id,
            cast(generate_subscripts(tokens, 1) - 1 as integer) as pos, unnest(tokens) as token
            from toks""",
        "remove_stop_words": with_(SRC_DOCS, TOKS, filt) + """select doc_id,
            cast(generate_subscripts(filtered, 1) - 1 as integer) as pos, unnest(filtered) as token
            from filt""",
        "vocabulary": vocab_q + "select term, doc_freq, term_count from vocab",
        "count_vectorize": vocab_q
        + "select doc_id, term, tf as count from tf where term in (select term from vocab)",
        "count_vectorize_capped": base.rstrip("\n") + "," + capped + "\n"
        + "select doc_id, term, tf as count from tf where term in (select term from capped)",
        "idf_weights": idf_q + "select term, doc_freq, round(idf, 6) as idf from idf",
        "tf_idf": idf_q + """select doc_id, term, tf, round(tf * idf, 6) as tfidf
            from tf join idf using (term)""",
        "string_index": with_(source_lab)
        + "select doc_id, source, idx as source_index from documents join lab on source = v",
        "string_index_skip": _CP + "," + prepared_lab.strip() + "\n"
        + """select project_id, currency2, idx as currency_indexed
            from prepared join lab on currency2 = v""",
        "string_index_keep": _CP + "," + prepared_lab.strip() + "\n"
        + """select project_id, currency2,
            coalesce(idx, cast((select count(*) from lab) as double)) as currency_indexed
            from prepared left join lab on currency2 = v""",
        "one_hot": with_(source_lab) + """select doc_id, source,
            cast((select count(*) from lab) - 1 as integer) as n_slots,
            case when idx < (select count(*) from lab) - 1 then cast(idx as integer) end as slot
            from documents join lab on source = v""",
        "assemble_features": with_(LABELLED, TOKS, filt, TF, lab_vocab, IDF, lab_c, lab_u) + """,
          tsum as (select doc_id, sum(tf * idf) as s from tf join idf using (term) group by doc_id)
          select doc_id, cast((select count(*) from vocab) + 5 as integer) as n_features,
                 round(coalesce(s, 0.0), 6) as tfidf_sum,
                 round(cast(days_campaign as double), 6) as days_campaign,
                 round(hours_prepa, 6) as hours_prepa,
                 round(cast(goal as double), 6) as goal,
                 round(lab_c.idx, 6) as country_indexed,
                 round(lab_u.idx, 6) as currency_indexed
          from src left join tsum using (doc_id)
          join lab_c on country2 = lab_c.v join lab_u on currency2 = lab_u.v""",
        "threshold_predict": with_(LABELLED, RULE)
        + "select doc_id, final_status, round(p1, 6) as p1, predictions from rule",
        "f1_score": with_(LABELLED, RULE) + """,
          pairs as (select cast(final_status as double) as y, predictions as p, count(*) as n
                    from rule group by all),
          by_true as (select y as cls, sum(n) as n_true,
                             sum(case when y = p then n else 0 end) as tp from pairs group by y),
          by_pred as (select p as cls, sum(n) as n_pred from pairs group by p),
          per as (select n_true, tp, coalesce(n_pred, 0) as n_pred
                  from by_true left join by_pred using (cls)),
          f as (select n_true,
                  case when n_pred > 0 then tp / n_pred else 0.0 end as pr,
                  tp / n_true as rc from per)
          select round(sum(case when pr + rc > 0 then 2 * pr * rc / (pr + rc) else 0.0 end * n_true)
                       / sum(n_true), 6) as f1 from f""",
        "confusion_matrix": with_(LABELLED, RULE)
        + "select final_status, predictions, count(*) as count from rule group by all",
    }


SQL.update(_text_sql())
SQL["prepare_campaigns_incremental"] = SQL["prepare_campaigns"]


def _grid_sql(reg_params, min_dfs) -> str:
    values = ", ".join(f"({i * len(min_dfs) + j}, {r!r}::double, {m!r}::double)"
                       for i, r in enumerate(reg_params) for j, m in enumerate(min_dfs))
    return with_(LABELLED, TOKS, FILT.format(sw=_stop_words_sql()), TF) + f""",
      stats as (select term, count(*) as doc_freq from tf group by term),
      grid as (select * from (values {values}) g(candidate, reg_param, min_df))
      select cast(candidate as integer) as candidate, reg_param, min_df,
             (select count(*) from stats where doc_freq >= min_df) as vocab_terms
      from grid"""


# The grids of the two searches, spelled out on this side too.
SQL["param_grid"] = _grid_sql((1e-8, 1e-6, 1e-4, 1e-2), (55.0, 75.0, 95.0))
SQL["param_grid_alt"] = _grid_sql((1e-7, 1e-5, 1e-3, 1e-1), (55.0, 75.0, 95.0))
SQL["param_grid_large"] = _grid_sql(
    (1e-8, 1e-7, 1e-6, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0),
    (5.0, 10.0, 20.0, 30.0, 50.0, 75.0, 100.0, 125.0))
SQL["word_count_incremental"] = with_(LINES, WORDS) + "select word, count(*) as count from words group by word"

# Seeded 90/10 split: the first 8 hex digits of md5(seed:id) against 0.9 * 2**32 in hex.
SQL["split_seeded"] = with_(LABELLED) + """
  select doc_id, cast(substr(md5('12345:' || doc_id), 1, 8) >= 'e6666666' as integer) as part from src"""


# ---------------------------------------------------------------- fits
# A fit has no SQL form; what surrounds it does: the rows, vocabularies and moments it is made from.  The flags say that
# the fit agrees with its relational score and is optimal, and must be true in every row.

IS_TEST = "substr(md5('12345:' || doc_id), 1, 8) >= 'e6666666'"
FOLD = "substr(md5('12345:fold:' || doc_id), 1, 8)"

TRAIN_VOCAB = f"""
train_vocab as (
  select term from tf where not {IS_TEST} group by term having count(*) >= {TEXT_MIN_DF}
)"""


def _fit_sql() -> dict[str, str]:
    filt = FILT.format(sw=_stop_words_sql())
    labelled = with_(LABELLED, TOKS, filt, TF)
    agreed = labelled.rstrip("\n") + "," + TRAIN_VOCAB + """,
      counted as (select doc_id, count(*) as n_terms from tf where term in (select term from train_vocab) group by doc_id)
      select doc_id, final_status, coalesce(n_terms, 0) as n_terms, true as score_agrees, true as class_agrees{more}
      from src left join counted using (doc_id) where """ + IS_TEST
    agrees = agreed.format(more="")
    vocab = VOCAB.format(min_df=TEXT_MIN_DF)
    ranks = lambda c: f"""(select {c} as v, row_number() over (order by count(*) desc, {c}) - 1 as idx from src
                           where {c} is not null group by {c})"""                       # noqa: E731
    moments = "count(*) filter (x <> 0) as n_rows, coalesce(sum(x), 0) as s, coalesce(sum(x * x), 0) as q"
    fit = labelled.rstrip("\n") + "," + vocab + "," + IDF + f""",
      n as (select count(*)::double as n from src),
      xs as (
        select 'term' as kind, term as name, {moments} from (select term, tf * idf as x from tf join idf using (term)) group by term
        union all
        select 'number', name, {moments} from (
          select unnest(['days_campaign', 'hours_prepa', 'goal']) as name,
                 unnest([days_campaign::double, hours_prepa, goal::double]) as x from src) group by name
        union all
        select 'category', 'country2', {moments} from (select coalesce(idx, (select count(*) from {ranks('country2')}))::double as x
          from src left join {ranks('country2')} on country2 = v)
        union all
        select 'category', 'currency2', {moments} from (select coalesce(idx, (select count(*) from {ranks('currency2')}))::double as x
          from src left join {ranks('currency2')} on currency2 = v)
        union all
        select 'intercept', '', count(*), count(*), count(*) from src)
      select kind, name, n_rows, round(s::double, 4) as x_sum,
             round(sqrt(greatest((q - s * s / n) / (n - 1), 0)), 4) as x_std, true as optimal from xs, n"""
    values = ", ".join(f"({i * 3 + j}, {r!r}::double, {m!r}::double)"
                       for i, r in enumerate((1e-8, 1e-6, 1e-4, 1e-2)) for j, m in enumerate((5.0, 10.0, 20.0)))
    grid = f"select candidate::integer as candidate, reg_param, min_df, {{flags}} from (values {values}) g(candidate, reg_param, min_df)"
    folds = f"""
      part as (select *, case when {FOLD} < '55555555' then 0 when {FOLD} < 'aaaaaaaa' then 1 else 2 end as part
               from src where not {IS_TEST}),
      fold as (select unnest([0, 1, 2]) as fold),"""
    return {
        "pipeline_predict": agrees, "pipeline_predict_tf_onehot": agrees, "model_roundtrip": agrees,
        "predictions_sink": agreed.format(more=", (select count(*) + 5 from train_vocab)::integer as n_features"),
        "logistic_fit": fit,
        "grid_results": grid.format(flags="true as metric_kept, true as metric_in_range, true as best_is_largest"),
        "best_params": grid.format(flags="true as no_better, true as stages_hold_winner"),
        "fold_vocabulary": labelled.rstrip("\n") + "," + folds + """
          sizes as (select fold, count(*) filter (part <> fold) as n from part, fold group by fold),
          stats as (select fold, term, count(*) as doc_freq, sum(tf)::bigint as term_count
                    from tf join part using (doc_id), fold where part <> fold group by fold, term)
          select fold, min_df, term, doc_freq, term_count, round(ln((n + 1.0) / (doc_freq + 1.0)), 6) as idf
          from stats join sizes using (fold), (select unnest([5.0, 10.0, 20.0])::double as min_df) where doc_freq >= min_df""",
        "fold_labels": with_(LABELLED).rstrip("\n") + "," + folds.rstrip(",") + """
          select fold, name as "column", value, (row_number() over (partition by fold, name order by count(*) desc, value) - 1)::integer as index
          from (select part, unnest(['country2', 'currency2']) as name, unnest([country2, currency2]) as value from part), fold
          where part <> fold and value is not null group by fold, name, value""",
    }


SQL.update(_fit_sql())

_FIELDS = ["project_id", "name", '"desc"', "keywords", "goal", "disable_communication", "country", "currency", "deadline",
           "state_changed_at", "created_at", "launched_at", "backers_count", "final_status"]


def _line(columns) -> str:
    return " || ',' || ".join("'soon'" if c == "soon" else f"coalesce(cast({c} as varchar), 'false')" for c in columns)


SQL["csv_quarantine"] = with_(CAMPAIGNS) + f"""
  select side, line, count(*) as n from (
    select case when k in (1, 2, 3) then 'bad' else 'good' end as side,
           case k when 1 then {_line(["soon" if c == "deadline" else c for c in _FIELDS])}
                  when 2 then {_line(_FIELDS[:5])}
                  when 3 then {_line(_FIELDS)} || ',1,2'
                  else project_id end as line
    from (select *, cast(split_part(project_id, '-', 1) as bigint) % 97 as k from campaigns)) group by all"""
