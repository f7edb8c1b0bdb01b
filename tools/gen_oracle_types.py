"""Regenerate tenure/plans/oracle_doubles.py: the double-typed output
columns of every oracle-backed query (used to round both sides to 6 digits
in the driver contract).  With names, only those are looked up anew.
usage: python tools/gen_oracle_types.py [sf_dir [name ...]]"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql.types import DoubleType, FloatType  # noqa: E402

from tenure.plans.registry import ORACLE, QUERIES  # noqa: E402
from tenure.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session("8")
    from tenure.plans.oracle_doubles import DOUBLE_COLUMNS

    names = sys.argv[2:] or sorted(ORACLE)
    out = {k: v for k, v in DOUBLE_COLUMNS.items() if k in ORACLE and k not in names}
    for name in names:
        schema = QUERIES[name](spark, sf).schema
        cols = [f.name for f in schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
        if cols:
            out[name] = cols
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tenure", "plans", "oracle_doubles.py")
    with open(path, "w") as fh:
        fh.write('"""Generated by tools/gen_oracle_types.py: double columns per oracle query."""\n\n')
        fh.write("DOUBLE_COLUMNS = {\n")
        for k, v in sorted(out.items()):
            fh.write(f"    {k!r}: {v!r},\n")
        fh.write("}\n")
    print(len(out), "queries with double columns")


if __name__ == "__main__":
    main()
