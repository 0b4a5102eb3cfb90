"""Fixture envelopes: reply parents and roots come from equi-joins, right even when one
conversation holds most turns."""

import json

from eventlake.plans import fixtures as fx


def test_envc_parents_and_roots_with_a_hot_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(300)]
    rows += [(2, 0, "assistant", "x"), (2, 1, "user", "y")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): json.loads(r.value) for r in fx.envc(conv).collect()}
    assert len(got) == len(rows)
    for (cid, turn), doc in got.items():
        reply = doc["commit"]["record"].get("reply")
        if turn == 0:
            assert reply is None
            continue
        prev_role = next(r[2] for r in rows if r[0] == cid and r[1] == turn - 1)
        root_role = next(r[2] for r in rows if r[0] == cid and r[1] == 0)
        assert reply == {"parent": f"did:t:c{cid}:{prev_role}", "root": f"did:t:c{cid}:{root_role}"}
    plan = fx.envc(conv)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # no per-conversation sort in one task
