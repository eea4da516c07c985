from __future__ import annotations

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from spanloom.llm import chat
from spanloom.llm.common import table


@pytest.mark.parametrize("text", ["", "plain", "<|im_end|>", "\\", "\\\\", "<\\|", "<|im_start|>assistant ok", "a\\n<||>", "<", "|>", "\\<|\\", "𠀀<|é"])
def test_escaping_is_reversible(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(chat.escape(F.col("t")).alias("e"), chat.escape_role(F.concat("t", F.lit("\n"))).alias("r")).first()
    assert "<|" not in row.e and chat.unescape(row.e) == text
    assert "\n" not in row.r and chat.unescape(row.r, True) == text + "\n"


def test_conversations(spark, sf):
    c = table(spark, sf, "conversations")
    got = sorted(map(tuple, chat.read_back(chat.formatted(chat.reply_chains(chat.with_trial(c)))).collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    assert got == sorted(con.sql(chat.ORACLE).fetchall())


def test_cases(spark):
    rows = [(1, 0, "user", None), (1, 0, None, "b"), (1, 1, "assistant", "c<|im_end|>"), (1, 1, "assistant", "c<|im_end|>"), (None, 3, "us\ner", "x"), (2, None, "assistant", "")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, leaf string")
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(chat.reply_chains(df))).collect()}
    assert got[1].n_turns == 4 and got[1].loss_chars == 22 and got[1].loss_sha256 == hashlib.sha256(b"c<|im_end|>" * 2).hexdigest()
    assert got[1].turns_sha256 == hashlib.sha256("\nb\nuser\n\nassistant\nc<|im_end|>\nassistant\nc<|im_end|>\n".encode()).hexdigest()
    assert got[None].turns_sha256 == hashlib.sha256(b"us\ner\nx\n").hexdigest() and got[2].loss_chars == 0
    assert chat.read_back(chat.formatted(chat.reply_chains(df.limit(0)))).count() == 0


def test_trees(spark):
    #   1 -> 2 -> 4      7 -> 8 (its parent 99 is missing)     10 <-> 11 is a cycle
    #     -> 3 -> 5, 6
    nodes = [("a", 1, None, 0.0), ("a", 2, 1, 1.0), ("a", 4, 2, 1.0), ("a", 3, 1, 5.0), ("a", 5, 3, 0.5), ("a", 6, 3, 2.0), ("b", 7, 99, 1.0), ("b", 8, 7, 1.0), ("c", 10, 11, 1.0), ("c", 11, 10, 1.0)]
    df = spark.createDataFrame([(*n, "user", str(n[1])) for n in nodes], "tree string, node long, parent long, score double, role string, text string")
    ways = {}
    for r in chat.paths(df).orderBy(F.desc("dist")).collect():
        ways.setdefault((r.tree, r.leaf), []).append(r.node)
    assert ways == {("a", 4): [1, 2, 4], ("a", 5): [1, 3, 5], ("a", 6): [1, 3, 6], ("b", 8): [7, 8]}
    best = {(r.tree, r["rank"]): [t for _, t in chat.turns_of(r.formatted)] for r in chat.formatted(df, best=2).collect()}
    assert best == {("a", 1): ["1", "3", "6"], ("a", 2): ["1", "3", "5"], ("b", 1): ["7", "8"]}
