"""Perspective rotation against a plain rendering."""
from collections import defaultdict

from pyspark.sql import types as T

from searchscore.llm import chat_rotation as C

from conftest import SF_SMALL


def slow(rows, part_turns=64):
    """{(conv, perspective, part, piece): (text, spans, mask)}"""
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        name = "_".join((role or "").strip(" ").split()) or "unknown"
        conv[c].append((turn if turn is not None else float("-inf"), name, text or ""))
    out = {}
    for c, turns in conv.items():
        for who in {n for _, n, _ in turns} - {"system"}:
            parts = defaultdict(list)
            for t in sorted(turns):
                parts[-1 if t[0] == float("-inf") else t[0] // part_turns].append(t)
            for p, ts in [((p, i // part_turns), ts[i:i + part_turns]) for p, ts in parts.items() for i in range(0, len(ts), part_turns)]:
                text, spans, mask = "", [], []
                for _, name, body in ts:
                    head = "assistant" if name == who else "system" if name == "system" else f"user name={name}"
                    text += f"<|im_start|>{head}\n"
                    start = len(text)
                    text += f"{body}<|im_end|>\n"
                    mask.append(int(name == who))
                    if name == who:
                        spans.append((start, len(text)))
                out[c, who, *p] = text, spans, mask
    return out


def check(spark, rows, got):
    mine = {(r["conv_id"], r["perspective"], r["part"], r["piece"]): (r["text"], [tuple(s) for s in r["train_spans"]], r["train_mask"]) for r in got}
    assert mine == slow(rows)
    for r in got:
        assert r["n_chars"] == len(r["text"]) and r["n_turns"] == len(r["train_mask"])


def test_table(spark):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in turns.collect()]
    check(spark, rows, C.rotate(turns).collect())


def test_edge_cases(spark):
    rows = [(1, i, ["ann", "bob", "system", "cy"][i % 4], f"t{i} é😀") for i in range(200)]  # several parts
    rows += [(2, 0, "ann", "same"), (2, 0, "ann", "same"), (2, 0, "bob", None), (2, None, "bob", ""), (2, 1, None, "x"), (2, 2, " ", "y")]
    rows += [(3, 0, "system", "alone"), (None, 0, "ann", "null conversation"), (None, 1, "bob", "b" * 100_000)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, part int, name string")
    check(spark, rows, C.rotate(df).collect())


def test_marks_in_content_do_not_end_a_turn(spark):
    df = spark.createDataFrame([(1, 0, "a<|b", "x<|im_end|>\n<|im_start|>system"), (1, 1, "c", "ok")], "conv_id long, turn long, role string, text string")
    for r in C.rotate(df).collect():
        assert r["text"].count("<|im_start|>") == r["text"].count("<|im_end|>") == 2


def test_empty_table(spark):
    assert C.rotate(spark.createDataFrame([], T.StructType.fromDDL("conv_id long, turn long, role string, text string"))).count() == 0


def test_many_rows_under_one_conversation_and_number(spark):
    """A third of all rows with null ids and equal or null numbers, and many equal rows, in pieces of at most 64."""
    rows = [(None, 3, ["ann", "bob"][i % 2], f"t{i * 7 % 1000}") for i in range(1_000)] + [(None, None, "ann", "same")] * 700
    rows += [(5, 130, "cy", f"x{i % 3}") for i in range(200)] + [(c, i, ["ann", "bob"][i % 2], f"{c} {i}") for c in range(10, 110) for i in range(20)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    got = C.rotate(df).collect()
    check(spark, rows, got)
    assert max(r["n_turns"] for r in got) == 64 and sum(r["n_turns"] for r in got if r["conv_id"] is None and r["perspective"] == "ann") == 1_700
