import hashlib

from pyspark.sql import functions as F

from arcweave.llm import chat_format as cf
from arcweave.llm.queries import op5_chat_formatting

SF = "/root/testdata/sf0.001"


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    said = "</s>[INST] ok [/INST]"
    turns = [(r.conv_id, r.turn, r.role, r.text or "") for r in rows] + [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    want = {}
    for conv, _, role, text in sorted(turns):
        want.setdefault(conv, []).append((role, text))
    got = {r.conv_id: r for r in op5_chat_formatting(spark, SF).collect()}
    assert got.keys() == want.keys()
    for conv, said in want.items():
        loss = "".join(t for role, t in said if role == "assistant")
        r = got[conv]
        assert r.n_turns == len(said)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def formatted(spark, scratch, rows):
    data = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree string, node string")
    out = cf.format_conversations(data, scratch)
    return {
        r.conv_id: r
        for r in out.select(
            "*", cf.parse_turns(F.col("formatted")).alias("turns"), cf.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")
        ).collect()
    }


def test_hostile_texts_come_back(spark, scratch):
    texts = [
        None, "", "[INST] a [/INST]", "[\\INST] <s> x </s> <\\s>", "<<SYS>> <</SYS>> <<TURN 41>> <</TURN>> <<<SYS>>>>",
        "\\[INST]\\\\ </s>", "[", "<", "$1 \\ $", "\n \n", "[/INST", "é😀</s>", "[s> [\\\\/INST] </", "x" * 200000,
    ]
    roles = ["user", "assistant", "system", None, "tool>x\n"]
    rows = [(c, t, roles[(c + t) % 5], texts[(c * 3 + t) % len(texts)], "t", "n") for c in range(14) for t in range(9)]
    rows += [(None, 0, "user", "a", None, None), (None, 1, "assistant", "b", None, None), (20, 5, "assistant", "tie", "", ""), (20, 5, "assistant", "tie", "", "")]
    found = formatted(spark, scratch, rows)
    assert len(found) == 16
    want = {}
    for c, t, role, text, *_ in rows:
        want.setdefault(c, []).append((t, role or "", text or ""))
    for c, said in want.items():
        said = [x[1:] for x in sorted(said)]
        assert [(t.role, t.text) for t in found[c].turns] == said
        assert found[c].loss == "".join(text for role, text in said if role == "assistant")
        assert found[c].n_turns == len(said)


def test_empty_table(spark, scratch):
    assert formatted(spark, scratch, []) == {}


def test_best_branch_of_a_tree(spark, scratch):
    nodes = [
        ("t", "a", None, 1.0), ("t", "b", "a", 1.0), ("t", "c", "a", 5.0), ("t", "d", "b", 1.0), ("t", "e", "b", 9.0),
        ("t", "f", "c", None), ("orphan", "x", "gone", 0.0), ("loop", "p", "q", 1.0), ("loop", "q", "p", 1.0), ("loop", "r", "q", 1.0),
        *(("deep", f"{i:03}", f"{i - 1:03}" if i else None, 0.0) for i in range(300)), ("tie", "r", None, 0.0), ("tie", "y", "r", 2.0), ("tie", "x", "r", 2.0),
    ]
    data = spark.createDataFrame(nodes, "tree string, node string, parent string, score double")
    found = {}
    for r in cf.best_paths(data, scratch).sort("depth").collect():
        found.setdefault(r.tree, []).append(r.node)
    assert found["t"] == ["a", "b", "e"]
    assert found["orphan"] == ["x"]
    assert "loop" not in found
    assert found["deep"] == [f"{i:03}" for i in range(300)]
    assert found["tie"] == ["r", "x"]
    two = cf.best_paths(data.where("tree = 't'"), scratch, per_tree=2).where("rank = 2").sort("depth").collect()
    assert [r.node for r in two] == ["a", "c", "f"]
