"""Spark vs SQL-twin column types for every checked key (python tests/schema_check.py [sf_dir])."""
import sys
import os
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT); sys.path.insert(0, os.path.join(ROOT, 'tests'))
import __spark_entry__ as E
from oracle_check import duck
from segmint.session import get_spark
spark = get_spark(shuffle_partitions=8)
sf = sys.argv[1] if len(sys.argv) > 1 else '/root/testdata/sf0.001'
con = duck(sf)
M = {'string':'VARCHAR','int':'INTEGER','bigint':'BIGINT','double':'DOUBLE','date':'DATE','timestamp_ntz':'TIMESTAMP','boolean':'BOOLEAN'}
qs, sql = E.queries(), E.oracle_sql()
for k in sorted(sql):
    df = qs[k](spark, sf)
    st = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cur = con.execute(f"DESCRIBE {sql[k]}").fetchall()
    dt = {r[0]: r[1] for r in cur}
    bad = []
    for c, t in st.items():
        exp = M.get(t, t.upper())
        if dt.get(c) != exp:
            bad.append(f"{c}: spark {t} duck {dt.get(c)}")
    print(f"{k:26s}", "OK" if not bad else "; ".join(bad))
