"""Compare Spark result column types with the DuckDB oracle's result types."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check_oracle import duck  # noqa: E402

from myosig.plans import all_queries  # noqa: E402
from myosig.session import local_session  # noqa: E402

MAP = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "float": "FLOAT", "array<double>": "DOUBLE[]", "array<float>": "FLOAT[]", "timestamp_ntz": "TIMESTAMP",
}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session()
    con = duck(sf)
    bad = 0
    for name, q in all_queries().items():
        if not q.sql:
            continue
        st = {f.name: f.dataType.simpleString() for f in q.build(spark, sf).schema.fields}
        rel = con.sql(q.sql)
        dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
        diffs = [(c, st.get(c), dt.get(c)) for c in sorted(set(st) | set(dt)) if MAP.get(st.get(c), st.get(c)) != dt.get(c)]
        if diffs:
            bad += 1
            print(f"TYPES {name}: {diffs}")
    print(f"{bad} queries with type differences")


if __name__ == "__main__":
    main()
