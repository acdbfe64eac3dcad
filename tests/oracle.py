"""Compare a registered query with its SQL on the same tables."""

import decimal
import os
import sys
import time

import duckdb

NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
         "conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = rows([d[0] for d in cur.description], cur.fetchall())
    return df, got, want


def main():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as e
    from tarnlake.session import build_session

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    only = sys.argv[1:]
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false",
                          spark__driver__bindAddress="127.0.0.1", spark__driver__host="127.0.0.1")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf), e.oracle_sql(), 0
    for name, query in e.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            if name not in sqls:
                print(f"rows  {name}: {query(spark, sf).count()} ({time.time() - start:.1f}s)", flush=True)
                continue
            df, got, want = compare(spark, con, sf, query, sqls[name])
            ok = got == want
            print(f"{'ok   ' if ok else 'DIFF '} {name}: {len(got[1])} rows ({time.time() - start:.1f}s) "
                  f"{[f.dataType.simpleString() for f in df.schema.fields]}", flush=True)
            if not ok:
                bad += 1
                print("   columns", got[0], want[0], len(want[1]))
                for a, b in [(a, b) for a, b in zip(got[1], want[1]) if a != b][:3]:
                    print("   spark", a, "\n   sql  ", b)
        except Exception as x:  # report and go on with the next query
            bad += 1
            print(f"FAIL  {name}: {type(x).__name__}: {str(x)[:1500]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
