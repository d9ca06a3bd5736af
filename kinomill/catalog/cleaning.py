"""Registered queries: projection, formatting and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import text as T
from ..operators import dedupe, joins
from ..plans import domain as D
from ..plans import formatted
from .views import movie, with_views

# Markers put into the data, since the driver's tables have none.
_MARKED = {11: "N/A", 7: " NULL ", 5: "\\N", 3: ""}


def _documents(spark, d):
    return D.table(spark, d, "documents")


def _with_markers(spark, d):
    text = F.col("source")
    for step, marker in sorted(_MARKED.items()):
        text = F.when(F.col("doc_id") % step == 0, marker).otherwise(text)
    return _documents(spark, d).select("doc_id", text.alias("source"), "lang", "n_chars")


def normalize_whitespace(spark, d):
    return T.normalize_whitespace(_documents(spark, d)).select("doc_id", "text", "lang", "source", "n_chars")


def nullify_markers(spark, d):
    return T.nullify(_with_markers(spark, d), T.NA_MARKERS)


def format_values(spark, d):
    return T.format_values(_with_markers(spark, d), T.NA_MARKERS_BACKSLASH)


def fold_accents(spark, d):
    return _documents(spark, d).select("doc_id", T.fold_accents(F.col("text")).alias("text"))


def fold_signs(spark, d):
    """Titles with signs of Latin-1, formatted: the no-break space is a space like others."""
    key = F.col("p_partkey")
    signs = F.when(key % 6 == 0, "WALL·E").when(key % 6 == 1, "Alien³").when(key % 6 == 2, "8½").when(
        key % 6 == 3, "¡Three\u00a0\u00a0 Amigos!"
    ).when(key % 6 == 4, "«x» 5°").otherwise("\u00a0plain\u00a0")
    raw = D.table(spark, d, "part").select(
        key.cast("string").alias("movie_id"), F.concat(signs, F.lit(" (1999)")).alias("movie_title"), F.col("p_type").alias("genres")
    )
    return formatted.format_movies(raw).select("movie_id", "movie_title", "movie_year")


def strip_diacritics(spark, d):
    return _documents(spark, d).select("doc_id", T.fold_accents(F.col("text"), expand_letters=False).alias("text"))


def _titles(spark, d):
    year = F.concat(F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(") "))
    return D.table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 7 == 0, F.col("p_name")).otherwise(F.concat("p_name", year)).alias("t")
    )


def title_year(spark, d):
    t = F.col("t")
    return _titles(spark, d).select("p_partkey", S.strip_year(t).alias("title"), S.extract_year(t).alias("year"))


def _piped(spark, d):
    return D.table(spark, d, "part").select("p_partkey", F.concat("p_type", F.lit("|"), "p_brand", F.lit("|")).alias("g"))


def split_list(spark, d):
    parts = _piped(spark, d).select("p_partkey", S.split_list(F.col("g"), "|").alias("a"))
    return parts.select("p_partkey", F.size("a").alias("n"), F.array_join("a", ",").alias("joined"))


def clean_array(spark, d):
    parts = _piped(spark, d).select("p_partkey", S.clean_array(S.split_list(F.col("g"), "|")).alias("a"))
    return parts.select("p_partkey", F.size("a").alias("n"), F.array_join("a", ",").alias("joined"))


def prefix_id(spark, d):
    return D.table(spark, d, "customer").select(
        "c_custkey", S.prefix_id(F.lpad(F.col("c_custkey").cast("string"), 7, "0"), "tt").alias("movie_id")
    )


def safe_cast(spark, d):
    raw = F.when(F.col("c_custkey") % 4 == 0, "x").when(F.col("c_custkey") % 4 == 1, "").otherwise(
        F.col("c_nationkey").cast("string")
    )
    return D.table(spark, d, "customer").select("c_custkey", S.to_int(raw).alias("number"))


def epoch_to_timestamp(spark, d):
    seconds = (F.col("event_id") * 977 + 1_000_000_000).cast("string")
    raw = F.when(F.col("event_id") % 9 == 0, "bad").otherwise(seconds)
    return D.table(spark, d, "events").select("event_id", S.epoch_to_ts(raw).cast("timestamp_ntz").alias("moment"))


def epoch_out_of_range(spark, d):
    """Numbers of seconds beyond any calendar, in both directions, give NULL."""
    key = F.col("event_id")
    raw = F.when(key % 5 == 0, "99999999999999999").when(key % 5 == 1, "-9223372036854775808").otherwise((key * 977).cast("string"))
    return D.table(spark, d, "events").select("event_id", S.epoch_to_ts(raw).cast("timestamp_ntz").alias("moment"))


def flag_to_bool(spark, d):
    return D.table(spark, d, "labels").select(
        "doc_id", S.int_to_bool(F.col("quality")).alias("quality"), S.int_to_bool(F.col("toxic")).alias("toxic")
    )


def decode_codes(spark, d):
    code = F.col("s_nationkey") % 5
    return D.table(spark, d, "supplier").select("s_suppkey", S.decode(code, formatted.GENDER_CODES).alias("gender"))


def flatten_struct(spark, d):
    nested = D.table(spark, d, "orders").select(
        "o_orderkey", F.struct("o_orderstatus", "o_totalprice", "o_orderpriority").alias("body")
    )
    return S.flatten(nested, "body")


def explode_array(spark, d):
    lists = D.table(spark, d, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 5 == 0, F.array().cast("array<string>"))
        .when(F.col("p_partkey") % 7 != 0, F.split("p_name", " "))
        .alias("words"),
    )
    return S.unnest(lists, "words", "word")


def explode_array_outer(spark, d):
    lists = D.table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 7 != 0, F.split("p_name", " ")).alias("words")
    )
    return S.unnest(lists, "words", "word", keep_empty=True)


def resolve_id(spark, d):
    primary = F.when(F.col("p_partkey") % 3 != 0, D.movie_id("p_partkey"))
    return D.table(spark, d, "part").select("p_partkey", S.resolve_id(primary, F.col("p_size")).alias("id"))


def drop_column(spark, d):
    return S.drop_if_exists(D.table(spark, d, "supplier"), "s_acctbal", "not_there")


def canonical_timestamp(spark, d):
    raw = F.when(F.col("o_orderkey") % 6 == 0, "junk").otherwise(F.col("o_orderdate").cast("string"))
    return D.table(spark, d, "orders").select("o_orderkey", S.canonical_ts(raw).alias("moment"))


def dedupe_rows(spark, d):
    return dedupe.dedupe_rows(D.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


def dedupe_key(spark, d):
    lines = D.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return dedupe.dedupe_key(lines, ["l_orderkey", "l_linenumber"], ["l_extendedprice", "l_partkey", "l_suppkey"])


def _links(spark, d):
    return (
        D.table(spark, d, "part")
        .where(F.col("p_brand") != "Brand#1")
        .select(D.movie_id("p_partkey").alias("link_imdb"), F.col("p_partkey").cast("string").alias("link_tmdb"))
    )


def join_left(spark, d):
    lines = D.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    found = joins.lookup_left(lines, _links(spark, d), "l_partkey", "link_tmdb")
    return found.select("l_orderkey", "l_linenumber", "l_quantity", S.resolve_id(F.col("link_imdb"), F.col("l_partkey")).alias("movie"))


def join_semi(spark, d):
    pricey = D.table(spark, d, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.having_match(D.table(spark, d, "customer").select("c_custkey", "c_name"), pricey, ["c_custkey"])


def join_anti(spark, d):
    pricey = D.table(spark, d, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.without_match(D.table(spark, d, "customer").select("c_custkey", "c_name"), pricey, ["c_custkey"])


QUERIES = {
    f.__name__: f
    for f in (
        normalize_whitespace, nullify_markers, format_values, fold_accents, fold_signs, strip_diacritics, title_year, split_list,
        clean_array, prefix_id, safe_cast, epoch_to_timestamp, epoch_out_of_range, flag_to_bool, decode_codes, flatten_struct,
        explode_array, explode_array_outer, resolve_id, drop_column, canonical_timestamp, dedupe_rows, dedupe_key,
        join_left, join_semi, join_anti,
    )
}


# Written out for the SQL, so that a letter missing in the library shows.
_SPELLED = """
ß ss|Æ AE|æ ae|Œ OE|œ oe|Ø O|ø o|Ł L|ł l|Đ D|đ d|Ð D|ð d|Þ Th|þ th|ı i|‘ ''|’ ''|“ "|” "|– -|— --|… ...
¡ !|¢ C/|£ PS|¤ $?|¥ Y=|¦ |§ SS|¨ "|© (c)|ª a|« <<|¬ !|® (r)|¯ -|° deg|± +-|² 2|³ 3|´ ''|µ u|¶ P|· *|¸ ,
¹ 1|º o|» >>|¼  1/4|½  1/2|¾  3/4|¿ ?|× x|÷ /
"""


def _folded(text: str) -> str:
    for line in _SPELLED.strip().split("\n"):
        for entry in line.split("|"):
            letter, plain = entry[0], "|" if entry[0] == "¦" else entry[2:]
            text = f"replace({text}, '{letter}', '{plain}')"
    return f"replace(replace({text}, chr(160), ' '), chr(173), '')"


_SQL_MARKED = "source"
for _step, _marker in sorted(_MARKED.items()):
    _SQL_MARKED = f"case when doc_id % {_step} = 0 then '{_marker}' else {_SQL_MARKED} end"
_SQUEEZED = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
_MARKERS = "('', 'NA', 'N/A', 'NaN', 'NULL')"
_TITLE = "case when p_partkey % 7 = 0 then p_name else p_name || ' (' || cast(1950 + p_size as varchar) || ') ' end"
_PARTS = "string_split(p_type || '|' || p_brand || '|', '|')"

ORACLE = {
    "normalize_whitespace": f"select doc_id, {_SQUEEZED.format('text')} as text, {_SQUEEZED.format('lang')} as lang, "
    f"{_SQUEEZED.format('source')} as source, n_chars from documents",
    "nullify_markers": f"select doc_id, case when source not in {_MARKERS} then source end as source, lang, n_chars "
    f"from (select doc_id, {_SQL_MARKED} as source, lang, n_chars from documents) x",
    "format_values": "select doc_id, case when source not in ('', 'NA', 'N/A', 'NaN', 'NULL', '\\N') then source end as source, "
    f"lang, n_chars from (select doc_id, {_SQUEEZED.format('(' + _SQL_MARKED + ')')} as source, lang, n_chars from documents) x",
    "fold_accents": f"select doc_id, {_folded('strip_accents(text)')} as text from documents",
    "fold_signs": "select 'tt' || cast(p_partkey as varchar) as movie_id, case p_partkey % 6 when 0 then 'WALL*E' when 1 then 'Alien3' "
    "when 2 then '8 1/2' when 3 then '!Three Amigos!' when 4 then '<<x>> 5deg' else 'plain' end as movie_title, 1999 as movie_year from part",
    "strip_diacritics": "select doc_id, strip_accents(text) as text from documents",
    "title_year": "select p_partkey, regexp_replace(trim(t), '\\s*\\(\\d{4}\\)$', '') as title, "
    "try_cast(nullif(regexp_extract(trim(t), '\\((\\d{4})\\)$', 1), '') as int) as year "
    f"from (select p_partkey, {_TITLE} as t from part) x",
    "split_list": f"select p_partkey, cast(len({_PARTS}) as int) as n, array_to_string({_PARTS}, ',') as joined from part",
    "clean_array": f"select p_partkey, cast(len(a) as int) as n, array_to_string(a, ',') as joined from "
    f"(select p_partkey, list_filter({_PARTS}, lambda x: x is not null and x <> '') as a from part) x",
    "prefix_id": f"select c_custkey, {movie('c_custkey')} as movie_id from customer",
    "safe_cast": "select c_custkey, case when c_custkey % 4 > 1 then c_nationkey end as number from customer",
    "epoch_to_timestamp": "select event_id, case when event_id % 9 <> 0 then "
    "timestamp '1970-01-01 00:00:00' + to_seconds(event_id * 977 + 1000000000) end as moment from events",
    "epoch_out_of_range": "select event_id, case when event_id % 5 > 1 then "
    "timestamp '1970-01-01 00:00:00' + to_seconds(event_id * 977) end as moment from events",
    "flag_to_bool": "select doc_id, quality = 1 as quality, toxic = 1 as toxic from labels",
    "decode_codes": "select s_suppkey, case s_nationkey % 5 when 0 then 'NotSet' when 1 then 'Female' when 2 then 'Male' "
    "when 3 then 'Non-binary' end as gender from supplier",
    "flatten_struct": "select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from orders",
    "explode_array": "select p_partkey, unnest(string_split(p_name, ' ')) as word from part where p_partkey % 5 <> 0 and p_partkey % 7 <> 0",
    "explode_array_outer": "select p_partkey, unnest(string_split(p_name, ' ')) as word from part where p_partkey % 7 <> 0 "
    "union all select p_partkey, null from part where p_partkey % 7 = 0",
    "resolve_id": f"select p_partkey, case when p_partkey % 3 <> 0 then {movie('p_partkey')} else cast(p_size as varchar) end as id from part",
    "drop_column": "select s_suppkey, s_name, s_nationkey from supplier",
    "canonical_timestamp": "select o_orderkey, case when o_orderkey % 6 <> 0 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as moment from orders",
    "dedupe_rows": "select distinct l_orderkey, l_linenumber, l_returnflag from lineitem",
    "dedupe_key": "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from "
    "(select *, row_number() over (partition by l_orderkey, l_linenumber order by l_extendedprice, l_partkey, l_suppkey) as rn from lineitem) x where rn = 1",
    "join_left": f"select l_orderkey, l_linenumber, l_quantity, case when p_partkey is not null then {movie('p_partkey')} "
    "else cast(l_partkey as varchar) end as movie from lineitem left join "
    "(select p_partkey from part where p_brand <> 'Brand#1') p on l_partkey = p_partkey",
    "join_semi": "select c_custkey, c_name from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 250000)",
    "join_anti": "select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 250000)",
}
