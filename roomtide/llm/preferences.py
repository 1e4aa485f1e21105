"""Preference formatting: one prompt, two masked completions, in DataFrame functions only.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns is rendered once as
the prompt; what follows on either side is a completion. A completion's spans are the code points, from its start, of
the assistant's words and end marks: the loss counts there and is masked elsewhere.

Defined cases: turns are ordered by turn, role and text, nulls first; repeated rows are one turn; a null role is
``user`` and a null text is empty; rows with a null conversation are left out; a pair without one of its
sides is left out; equal conversations share all turns and have empty completions; conversations that differ at
once have an empty prompt; the markers inside a text are broken by a space; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (role, text) with markers broken."""
    text = F.coalesce(F.col("text"), F.lit(""))
    for marker in (START, END):
        text = F.replace(text, F.lit(marker), F.lit(f"{marker[:2]} {marker[2:]}"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("user")).alias("role"), text.alias("text"),
    )
    ordered = F.array_sort(F.collect_set(F.struct(F.coalesce(F.col("turn"), F.lit(-(2**63))).alias("turn"), "role", "text")))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def common_turns(a: Column, b: Column) -> Column:
    """The number of leading turns that are equal."""
    most = F.least(F.size(a), F.size(b))
    differ = F.filter(F.sequence(F.lit(0), most), lambda i: (i == most) | ~F.get(a, i).eqNullSafe(F.get(b, i)))
    return F.get(differ, F.lit(0))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"), turn["text"], F.lit(END + "\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def spans(turns: Column) -> Column:
    """``start-end`` of what is trained on in ``render(turns)``, ends excluded, with commas between."""
    head = F.lit(len(START) + 1)
    found = F.aggregate(
        turns,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans")),
        lambda seen, turn: F.struct(
            (seen["at"] + F.char_length(_rendered(turn))).alias("at"),
            F.when(
                turn["role"] == TRAINED_ROLE,
                F.array_append(
                    seen["spans"],
                    F.concat_ws(
                        "-",
                        (seen["at"] + head + F.char_length(turn["role"])).cast("string"),
                        (seen["at"] + F.char_length(_rendered(turn)) - 1).cast("string"),
                    ),
                ),
            ).otherwise(seen["spans"]).alias("spans"),
        ),
    )
    return F.array_join(found["spans"], ",")


def format_pairs(pairs: DataFrame, turns: DataFrame) -> DataFrame:
    """Pairs (pair_id, chosen_id, rejected_id) with prompt_turns, prompt, completions and their spans."""
    every = conversations(turns)
    chosen = every.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("a"))
    rejected = every.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("b"))
    return _formatted(pairs.join(chosen, "chosen_id").join(rejected, "rejected_id"))


def _formatted(pairs: DataFrame) -> DataFrame:
    """The result's columns from pairs with their turns ``a`` and ``b``."""
    both = pairs.withColumn("prompt_turns", common_turns(F.col("a"), F.col("b")))
    rest = lambda side: F.slice(side, F.col("prompt_turns") + 1, F.size(side))
    return both.select(
        "pair_id", "chosen_id", "rejected_id", "prompt_turns",
        render(F.slice("a", F.lit(1), F.col("prompt_turns"))).alias("prompt"),
        render(rest(F.col("a"))).alias("chosen"),
        spans(rest(F.col("a"))).alias("chosen_spans"),
        render(rest(F.col("b"))).alias("rejected"),
        spans(rest(F.col("b"))).alias("rejected_spans"),
    )


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """Conversations 2k and 2k + 1 as pair k, the even one chosen: a stand-in where no preference is recorded."""
    ids = turns.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    pair = F.floor(F.col("conv_id") / 2).cast("long")
    return (
        ids.groupBy(pair.alias("pair_id"))
        .agg(F.min("conv_id").alias("chosen_id"), F.max("conv_id").alias("rejected_id"))
        .filter("chosen_id < rejected_id")
    )


def reply_pairs(turns: DataFrame) -> DataFrame:
    """A row for each conversation, as ``format_pairs`` gives it: chosen as it is, rejected with the last assistant turn
    of another conversation in place of its own. The pair is the conversation, rejected_id the one that lends the turn.

    Conversations with an assistant turn lend it in a ring by id, in groups of some hundred by the md5 of the id.
    Without an assistant turn, both completions are empty and nobody lends; one alone in its group has its turn left out.
    A lent turn that equals the own one leaves both completions empty as well.
    """
    last = F.array_max(
        F.transform("turns", lambda t, k: F.when(t["role"] == TRAINED_ROLE, k + 1).otherwise(F.lit(0)))
    )
    every = conversations(turns).withColumn("last", last)
    lenders = every.filter(F.col("last") > 0)
    many = turns.filter(F.col("conv_id").isNotNull() & F.col("role").eqNullSafe(TRAINED_ROLE)).agg(
        F.count_distinct(F.col("conv_id").cast("long"))
    ).first()[0]
    digits = len(f"{many // 64:x}") - 1
    group = F.substring(F.md5(F.col("conv_id").cast("string")), 1, digits)
    ring = Window.partitionBy("group").orderBy("conv_id")
    around = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lent = lenders.select("conv_id", group.alias("group")).select(
        "conv_id", F.coalesce(F.lead("conv_id").over(ring), F.first("conv_id").over(around)).alias("lender")
    ).filter("lender <> conv_id")
    replies = lenders.select(F.col("conv_id").alias("lender"), F.get("turns", F.col("last") - 1).alias("reply"))
    given = lent.join(replies, "lender")
    own = F.col("turns")
    swapped = F.concat(
        F.slice(own, F.lit(1), F.col("last") - 1),
        F.when(F.col("reply").isNull(), F.slice(own, 1, 0)).otherwise(F.array("reply")),
        F.slice(own, F.col("last") + 1, F.size(own)),
    )
    return _formatted(
        every.join(given, "conv_id", "left").select(
            F.col("conv_id").alias("pair_id"), F.col("conv_id").alias("chosen_id"), F.col("lender").alias("rejected_id"),
            own.alias("a"), F.when(F.col("last") > 0, swapped).otherwise(own).alias("b"),
        )
    )


ORACLE_SQL = """
with t as (
 select distinct conv_id, coalesce(turn, -9223372036854775808) as turn, coalesce(role, 'user') as role,
  replace(replace(coalesce(text, ''), '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') as text
 from conversations where conv_id is not null),
n as (select *, row_number() over (partition by conv_id order by turn, role, text) as place,
  concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)) as line from t),
p as (select conv_id // 2 as pair_id, min(conv_id) as chosen_id, max(conv_id) as rejected_id
 from t group by 1 having min(conv_id) < max(conv_id)),
m as (select p.pair_id, coalesce(min(case when a.line is distinct from b.line then coalesce(a.place, b.place) end) - 1,
   count(*)) as prompt_turns
 from p join n on n.conv_id in (p.chosen_id, p.rejected_id)
 left join n a on a.conv_id = p.chosen_id and a.place = n.place
 left join n b on b.conv_id = p.rejected_id and b.place = n.place
 where n.conv_id = p.chosen_id or a.place is null group by 1),
s as (select p.pair_id, p.chosen_id, p.rejected_id, m.prompt_turns, n.conv_id = p.chosen_id as is_chosen, n.place, n.role, n.line,
  coalesce(sum(case when n.place > m.prompt_turns then length(n.line) end) over (
   partition by p.pair_id, n.conv_id order by n.place rows between unbounded preceding and 1 preceding), 0) as place_at
 from p join m using (pair_id) join n on n.conv_id in (p.chosen_id, p.rejected_id))
select pair_id, chosen_id, rejected_id, cast(prompt_turns as integer) as prompt_turns,
 coalesce(string_agg(line, '' order by place) filter (is_chosen and place <= prompt_turns), '') as prompt,
 coalesce(string_agg(line, '' order by place) filter (is_chosen and place > prompt_turns), '') as chosen,
 coalesce(string_agg(concat(cast(place_at + 13 + length(role) as bigint), '-', cast(place_at + length(line) - 1 as bigint)), ',' order by place)
  filter (is_chosen and place > prompt_turns and role = 'assistant'), '') as chosen_spans,
 coalesce(string_agg(line, '' order by place) filter (not is_chosen and place > prompt_turns), '') as rejected,
 coalesce(string_agg(concat(cast(place_at + 13 + length(role) as bigint), '-', cast(place_at + length(line) - 1 as bigint)), ',' order by place)
  filter (not is_chosen and place > prompt_turns and role = 'assistant'), '') as rejected_spans
from s group by pair_id, chosen_id, rejected_id, prompt_turns
"""

REPLY_SQL = """
with t as (
 select distinct conv_id, coalesce(turn, -9223372036854775808) as turn, coalesce(role, 'user') as role,
  replace(replace(coalesce(text, ''), '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') as text
 from conversations where conv_id is not null),
n as (select *, row_number() over (partition by conv_id order by turn, role, text) as place,
  concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)) as line from t),
l as (select conv_id, max(place) as last, left(md5(cast(conv_id as varchar)),
   cast(length(lower(to_hex(count(*) over () // 64))) - 1 as bigint)) as grp from n where role = 'assistant' group by conv_id),
g as (select conv_id, last, coalesce(lead(conv_id) over (partition by grp order by conv_id),
   min(conv_id) over (partition by grp)) as lender from l),
r as (select g.conv_id, g.last, nullif(g.lender, g.conv_id) as lender, n.line as reply from g
 left join l on l.conv_id = g.lender and g.lender <> g.conv_id left join n on n.conv_id = l.conv_id and n.place = l.last),
c as (select conv_id, r.last, r.lender, r.reply from (select distinct conv_id from n) left join r using (conv_id)),
-- A reply left out moves the turns behind it: where they equal what they replace, the prefix goes on.
b as (select n.conv_id, n.role, n.line, n.place - case when c.reply is null and n.place > c.last then 1 else 0 end as place
  from n join c using (conv_id) where c.last is null or n.place <> c.last
 union all select conv_id, 'assistant', reply, last from c where reply is not null),
m as (select n.conv_id, coalesce(min(case when b.line is distinct from n.line then n.place end) - 1, count(*)) as prompt_turns
 from n left join b on b.conv_id = n.conv_id and b.place = n.place group by 1),
e as (select conv_id, true as is_chosen, role, line, place from n union all select conv_id, false, role, line, place from b),
f as (select e.*, m.prompt_turns, coalesce(sum(case when place > prompt_turns then length(line) end) over (
   partition by conv_id, is_chosen order by place rows between unbounded preceding and 1 preceding), 0) as place_at
 from e join m using (conv_id))
select f.conv_id as pair_id, f.conv_id as chosen_id, c.lender as rejected_id, cast(prompt_turns as integer) as prompt_turns,
 coalesce(string_agg(line, '' order by place) filter (is_chosen and place <= prompt_turns), '') as prompt,
 coalesce(string_agg(line, '' order by place) filter (is_chosen and place > prompt_turns), '') as chosen,
 coalesce(string_agg(concat(cast(place_at + 13 + length(role) as bigint), '-', cast(place_at + length(line) - 1 as bigint)), ',' order by place)
  filter (is_chosen and place > prompt_turns and role = 'assistant'), '') as chosen_spans,
 coalesce(string_agg(line, '' order by place) filter (not is_chosen and place > prompt_turns), '') as rejected,
 coalesce(string_agg(concat(cast(place_at + 13 + length(role) as bigint), '-', cast(place_at + length(line) - 1 as bigint)), ',' order by place)
  filter (not is_chosen and place > prompt_turns and role = 'assistant'), '') as rejected_spans
from f join c using (conv_id) group by f.conv_id, c.lender, prompt_turns
"""
