"""A task that dies on its first attempt: the retried job gives the same tables.

Runs in its own Spark application (``local[4,3]`` allows task retries), in a
subprocess so it does not disturb the shared test session.
"""

import json
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import json, sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from cdrflow.session import get_session
    from cdrflow.params import FIXTURE_PARAMS, FIXTURE_MONTHS
    from cdrflow.plans.stages import fixture_stages
    from cdrflow.sources import files

    spark = get_session(master="local[4,3]", shuffle_partitions=4)
    st = fixture_stages(spark, "/root/testdata/sf0.001", FIXTURE_PARAMS)
    out = sys.argv[1]

    def flaky(batches):
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            raise RuntimeError("simulated executor loss")
        for b in batches:
            yield b

    mediated = st.mediated()
    broken = mediated.mapInPandas(flaky, mediated.schema)
    for name, m in (("clean", mediated), ("retried", broken)):
        files.write_rated(st.rated(m), f"{{out}}/{{name}}/rated")
        rated = files.read_rated(spark, f"{{out}}/{{name}}/rated")
        files.write_invoices(st.invoices(FIXTURE_MONTHS, rated=rated), f"{{out}}/{{name}}/invoice")

    def rows(path, reader):
        return sorted(json.dumps([str(v) for v in r]) for r in reader(spark, path).collect())

    same = all(
        rows(f"{{out}}/clean/{{t}}", r) == rows(f"{{out}}/retried/{{t}}", r)
        for t, r in (("rated", files.read_rated), ("invoice", files.read_invoices))
    )
    n = len(rows(f"{{out}}/clean/rated", files.read_rated))
    print(json.dumps({{"same": same, "rated_rows": n}}))
    """
)


def test_retried_task_gives_same_tables(tmp_path):
    script = tmp_path / "recovery.py"
    script.write_text(SCRIPT.format(root=ROOT))
    proc = subprocess.run(
        [sys.executable, str(script), str(tmp_path / "out")], capture_output=True, text=True, timeout=600
    )
    assert proc.returncode == 0, proc.stderr[-3000:]
    result = json.loads(proc.stdout.strip().splitlines()[-1])
    assert result["same"] and result["rated_rows"] > 0
    assert "simulated executor loss" in proc.stderr  # the failure really happened
