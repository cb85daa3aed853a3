"""Check that the Spark and DuckDB role mappings give identical tables."""

import sys

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

from oracle_compare import compare, duck_connect  # noqa: E402

from carelake.session import get_session  # noqa: E402
from carelake.sources.roles import from_driver_tables  # noqa: E402
from carelake.sources.roles_sql import with_roles  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = get_session("local[8]", 8)
spark.sparkContext.setLogLevel("ERROR")
h = from_driver_tables(spark, sf_dir)
con = duck_connect(sf_dir)
ok = True
for name, df in h.tables().items():
    r = compare(df, con, with_roles(f"SELECT * FROM {name}"))
    ok &= r["values_match"]
    print(name, r)
print("ALL OK" if ok else "MISMATCH")
