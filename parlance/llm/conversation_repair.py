"""Conversation structure repair by an integer-weight dynamic program (operator 12).

The turns of a conversation, in order, are edited at the least cost so that
their roles' initials read ``(s?(ua)+)?``: Keep (0), Rerole to user or assistant
(3), Delete (4; required for blank and duplicate turns), Insert an empty user or
assistant turn anywhere (3); a truncated turn that stays adds 3. The audit is
the edits' initials in order; of the cheapest the ASCII-least one is taken.

A plan of edits is one integer: its cost in the high digits, below them the
audit as base-8 digits (D, I, K, R = 1 to 4) from the left, the rest zero. A
shorter audit is thus less than its continuations, as in ASCII order. The
program runs over the DAG of (turns left, last role) from the end: putting an
edit before a plan moves the digits by one place, which keeps the order of
plans, so the plain minimum of integers settles cost and ties at once. Inserts
stand at most twice in a place (more only add cost), so 3 n + 2 digits suffice.

A turn's first fault counts: blank (no word), duplicate (role and text seen
earlier in the conversation), truncated (its last character that is no white
space is none of ``.!?``).

Rows: turns are ordered by turn (nulls first), role and text; a null role or
text reads as one space, so null and empty texts are blank and a null role fits
nowhere unless it is changed. Repeated rows are duplicates. Rows with a null
conv_id form one conversation. Other columns are not read. An empty table gives
an empty result. A conversation passes whole through one task, which streams its
partition: memory is that of the largest conversation.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {v: k for k, v in DIGIT.items()}
WIDTH = 3
#: Last role given: none, system, user, assistant. What may follow it, by initial.
START, S, U, A = range(4)
NEXT = {START: {"s": S, "u": U}, S: {"u": U}, U: {"a": A}, A: {"u": U}}
ROLE = {U: "user", A: "assistant"}
LEGAL = {"su", "ua", "au"}
SOLID = re.compile(f"[^{SPACE}]")

SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired array<struct<role:string,text:string>>"
)


def faults(turns: list[tuple[str, str]]) -> list[str]:
    """The first fault of every turn (role, text), or an empty text."""
    seen, out = set(), []
    for turn in turns:
        text = turn[1].rstrip(SPACE)
        if not text:
            out.append("blank")
        elif turn in seen:
            out.append("duplicate")
        else:
            out.append("" if text[-1] in ENDS else "truncated")
        seen.add(turn)
    return out


def plan(initials: list[str], found: list[str]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of turns with these role initials and faults."""
    places = 3 * len(initials) + 2
    high = WIDTH * places
    digits = (1 << high) - 1
    never = 1 << (high + (7 * places).bit_length() + 1)

    def put(letter: str, cost: int, rest: int) -> int:
        if rest >= never:
            return never
        low = rest & digits
        return rest - low + (cost << high) + (DIGIT[letter] << (high - WIDTH)) + (low >> WIDTH)

    def inserted(e: list[int]) -> list[int]:
        """The least plans from every state when turns may be inserted first."""
        one_user, both = put("I", INSERT, e[U]), put("I", INSERT, put("I", INSERT, e[A]))
        return [min(e[START], one_user, both), min(e[S], one_user, both), min(e[U], put("I", INSERT, e[A])), min(e[A], one_user)]

    best = inserted([0, never, never, 0])
    for initial, fault in zip(reversed(initials), reversed(found), strict=True):
        extra = TRUNCATED if fault == "truncated" else 0
        here = []
        for state in (START, S, U, A):
            options = [put("D", DELETE, best[state])]
            if fault not in ("blank", "duplicate"):
                given = U if "u" in NEXT[state] else A
                options.append(put("R", REROLE + extra, best[given]))
                if initial in NEXT[state]:
                    options.append(put("K", KEEP + extra, best[NEXT[state][initial]]))
            here.append(min(options))
        best = inserted(here)
    low = best[START] & digits
    shown = (LETTER.get(low >> WIDTH * (places - 1 - i) & 7, "") for i in range(places))
    return best[START] >> high, "".join(shown)


def apply(turns: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The turns after the edits of the audit; the roles given follow from those before."""
    out, state, at = [], START, 0
    for letter in audit:
        if letter != "D":
            role, text = turns[at] if letter != "I" else ("", "")
            state = NEXT[state][role[:1]] if letter == "K" else U if "u" in NEXT[state] else A
            out.append((role if letter == "K" else ROLE[state], text))
        at += letter != "I"
    return out


def report(conv_id, rows: list[tuple]) -> dict:
    """The result row of a conversation's rows (turn, role, text), in order."""
    turns = [(role, text) for _, role, text in rows]
    numbers = {turn for turn, _, _ in rows if turn is not None}
    found = faults(turns)
    initials = [role[:1] for role, _ in turns]
    cost, audit = plan(initials, found)
    return {
        "conv_id": conv_id,
        "gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        **{f: found.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(x + y not in LEGAL for x, y in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired": [{"role": r, "text": t} for r, t in apply(turns, audit)],
    }


def _reports(batches):
    """Conversations from rows (conv_id, present, turn, role, text) sorted by these; one may reach over batches."""
    kinds = pa.struct([("role", pa.string()), ("text", pa.string())])
    whole = [(n, pa.int64()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    schema = pa.schema([*whole, ("audit", pa.string()), ("repaired", pa.list_(kinds))])
    now, rows = (), []
    for batch in batches:
        done = []
        for conv_id, present, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != (conv_id,):
                if now:
                    done.append(report(now[0], rows))
                now, rows = (conv_id,), []
            if present:
                rows.append(tuple(row))
        yield pa.RecordBatch.from_pylist(done, schema)
    if now:
        yield pa.RecordBatch.from_pylist([report(now[0], rows)], schema)


def repair(turns: DataFrame, present: F.Column | None = None) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): SCHEMA.

    Rows for which ``present`` is not true only say that their conversation exists.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(" "))
    there = F.lit(True) if present is None else present
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), there.alias("present"),
        F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"),
    )
    order = ["conv_id", "present", F.col("turn").asc_nulls_first(), "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_reports, SCHEMA)


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): ``turns`` damaged by crc32(``conv_id:turn``) % 20.

    0 drops the row (present is false), 1 empties its text, 2 removes its
    ``.!?``, 3 repeats it, 4 makes it the user's. Nulls read as one space.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    said = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.col("kind") != 0, F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"),
        F.explode(copies).alias("present"),
    )


def digest(reports: DataFrame) -> DataFrame:
    """The reports with the SHA-256 of the repaired ``role:text`` lines instead of the turns."""
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return reports.select(*(c for c in reports.columns if c != "repaired"), F.sha2(lines, 256).alias("repaired_sha256"))
