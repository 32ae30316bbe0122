"""Queries on quantities in different units, and the SQL that other engines can run for them."""

from tamis.operators import units as U
from tamis.session import table


def p1_found(spark, sf_dir):
    """variant_id, net_g of every variant whose net weight is known."""
    df = U.net_quantities(table(spark, sf_dir, "product_variants"), table(spark, sf_dir, "feeds"))
    return df.withColumnsRenamed({"id": "variant_id", "net": "net_g"})


def p1_source_units(spark, sf_dir):
    """What each feed's note says of the units of its fields."""
    return U.source_units(table(spark, sf_dir, "feeds"))


QUERIES = {"p1_found": p1_found, "p1_source_units": p1_source_units}


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_q(x) for x in r) + ")" for r in rows)


_UNITS = f"""u(alias, unit, dimension, system, factor, shift) as (select a, b, c, d, cast(e as decimal(20,9)), cast(f as decimal(20,9)) from (values {_values(U.unit_rows())}) t(a, b, c, d, e, f)),
    w(word, number) as (select a, cast(b as decimal(18,6)) from (values {_values([(x, n) for n, v in U.WORDS.items() for x in v.split("|")])}) t(a, b)),
    k(unit, f) as (select unit, max(factor) from u where dimension = 'mass' group by unit)"""
_FEEDS = f"""n as (select source, max(lower(coalesce(export_note, ''))) as note from feeds group by source),
    nw as (select source, unnest(list_distinct(list_concat(regexp_split_to_array(note, '[^\\p{{L}}]+'), regexp_extract_all(note, '(킬로그램|킬로|그램|グラム|キロ)')))) as word from n),
    nu as (select source, list_distinct(list(unit)) as units from nw join u on alias = word where dimension = 'mass' and length(word) > 1 and not (unit = 'lb' and word = 'livre') group by source),
    nf as (select n.source, note, regexp_matches(note, {_q(U.NOTE_FIELD)}) as field, list_filter(units, lambda x: x <> 'g') as other, list_contains(units, 'g') as g from n left join nu using (source)),
    nn as (select *, case when len(other) = 1 then other[1] when len(other) = 0 and g then 'g' end as named from nf),
    src as (select source, case when not field then named end as weight_unit_default, coalesce(case when field then named end, 'g') as plain_unit, not regexp_matches(note, {_q(U.NOT_NET)}) as plain_ok from nn)"""
_TEXT = f"regexp_replace(regexp_replace(regexp_replace(lower(translate(replace(title, '㎏', 'kg'), {_q(U.WIDE_FROM)}, {_q(U.WIDE_TO)})), '[\\x{{00A0}}\\x{{2007}}\\x{{2009}}\\x{{202F}} \\t\\r\\n]', ' ', 'g'), {_q(U.NOISE)}, ' ', 'g'), '([^0-9 ])([/–—])', '\\1 \\2 ', 'g')"
_NUMBER = """case when number is not null then number
    when regexp_matches(raw, '^[0-9]{1,3}( [0-9]{3})+$') then cast(replace(raw, ' ', '') as decimal(18,6))
    when regexp_matches(raw, '^[0-9]{1,6} [0-9]/[0-9]{1,4}$') then cast(split_part(raw, ' ', 1) as decimal(18,6)) + cast(cast(split_part(split_part(raw, ' ', 2), '/', 1) as double) / cast(split_part(raw, '/', 2) as double) as decimal(18,6))
    when regexp_matches(raw, '^[0-9]{1,6} ?[½¼¾]$') then cast(regexp_extract(raw, '^([0-9]+)', 1) as decimal(18,6)) + case when contains(raw, '½') then 0.5 when contains(raw, '¼') then 0.25 else 0.75 end
    when regexp_matches(raw, '^[0-9]{1,6}/[0-9]{1,4}$') then cast(cast(split_part(raw, '/', 1) as double) / nullif(cast(split_part(raw, '/', 2) as double), 0) as decimal(18,6))
    when regexp_matches(raw, '^[1-9][0-9]{0,2}[.,][0-9]{3}$') and tu in ('g', 'mg') then cast(regexp_replace(raw, '[.,]', '') as decimal(18,6))
    when regexp_matches(raw, '^[0-9]{0,9}([.,][0-9]{1,9})?$') then cast('0' || replace(raw, ',', '.') as decimal(18,6)) end"""
_OTHER = ", ".join(_q(a) for k in ("ml", "cl", "l", "floz", "piece") for a in dict.fromkeys(U.ALIASES[k].split()))
SQL = {
    "p1_source_units": f"with {_UNITS}, {_FEEDS} select * from src",
    "p1_found": f"""with {_UNITS}, {_FEEDS},
    b0 as (select id as kk, source, coalesce({_TEXT}, '') as t, grams, weight, regexp_replace(lower(trim(coalesce(weight_unit, ''))), '\\.$', '') as uu from product_variants where id is not null),
    b1 as (select *, {" or ".join(f"regexp_matches(t, {_q(p)})" for p in (U.PACKS, U.SUM, U.RANGE, U.VOLUME, U.PIECES))} as refused, regexp_extract_all(t, {_q(U.MENTION)}, 0) as ms from b0),
    b2 as (select * exclude (ms), unnest(case when len(ms) = 0 then [null] else ms end) as m from b1),
    b3 as (select *, regexp_extract(m, {_q(U.MENTION)}, 1) as raw, regexp_extract(m, {_q(U.MENTION)}, 2) as al from b2),
    b4 as (select b3.*, w.number, x.unit as tu, x.system as ts, x.factor as tf from b3 left join w on w.word = raw left join u x on x.alias = al),
    b5 as (select *, cast(({_NUMBER}) * tf as decimal(24,6)) as said from b4),
    b6 as (select b5.*, plain_ok, k1.f as df, k2.f as pf, x.factor as uf from b5 left join src using (source) left join k k1 on k1.unit = weight_unit_default left join k k2 on k2.unit = plain_unit left join (select * from u where dimension = 'mass') x on x.alias = uu),
    b7 as (select *, cast(cast(case when weight > 0 then weight end as decimal(18,6)) * case when uu = '' then df else uf end as decimal(24,6)) as weighed, case when grams > 0 and plain_ok then cast(grams * pf as decimal(24,6)) end as plained,
        refused or (uu <> '' and uf is null and uu in ({_OTHER}) and said is null) as no from b6),
    g as (select kk, bool_or(no) as no, min(said) filter (ts = 'metric') as m0, max(said) filter (ts = 'metric') as m1, min(said) filter (ts = 'imperial') as i0, max(said) filter (ts = 'imperial') as i1, max(weighed) as weighed, max(plained) as plained from b7 group by kk),
    r as (select kk, case when m0 is not null or i0 is not null then
        case when m0 = m1 and (i0 is null or (abs(i0 - m0) <= greatest(2.0, m0 * 0.02) and abs(i1 - m0) <= greatest(2.0, m0 * 0.02))) then m0
             when m0 is null and abs(i0 - i1) <= greatest(2.0, i1 * 0.02) then i1 end else coalesce(weighed, plained) end as net from g where not no)
    select kk as variant_id, cast(round(net, 0) as bigint) as net_g from r where round(net, 0) > 0""",
}
