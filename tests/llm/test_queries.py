import re

import __spark_entry__ as entry

NO_SQL = {"op1_toxicity_nbsvm", "op2_pii_feistel", "op3_best_fit_packing", "op4_byte_bpe", "op7_quality_rules", "op13_tokenizer_alignment", "pipeline"}


def test_every_dealt_operator_has_one_query():
    numbers = sorted(int(m[1]) for k in entry.queries() if (m := re.match(r"op(\d+)_", k)))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_sql_wherever_sql_can_express_the_query():
    own = {k for k in entry.queries() if re.match(r"op\d+_", k)} | {"pipeline"}
    assert own - set(entry.oracle_sql()) == NO_SQL


def test_nothing_else_imports_this_subpackage():
    import os

    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, names in os.walk(os.path.join(root, "vellum")):
        if folder.endswith("llm"):
            continue
        for n in (x for x in names if x.endswith(".py")):
            with open(os.path.join(folder, n)) as f:
                assert "vellum.llm" not in f.read(), n
