
import json
import sys
import time

from bench import HEADLINE
from catalog.oracles import ORACLES
from tests.compare import connect

if __name__ == "__main__":
    con = connect(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
    con.execute("SET threads = 8")
    timed = {}
    for query in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            con.sql(ORACLES[query]).arrow().read_all() if hasattr(con.sql("select 1").arrow(), "read_all") else con.sql(ORACLES[query]).arrow()
            timed[query] = round(time.perf_counter() - start, 3)
    print(json.dumps(timed))
