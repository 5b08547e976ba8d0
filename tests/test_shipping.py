"""Code that runs in Python workers is shipped by value: a process that cannot import the
package still unpickles and runs it (as an executor without an installed copy would)."""

import os
import subprocess
import sys


def test_worker_functions_pickle_by_value(tmp_path):
    from pyspark import cloudpickle

    from oratio.operators.profiles import parse_profile

    payload = cloudpickle.dumps(parse_profile)
    script = ("import pickle, sys\n"
              "f = pickle.loads(sys.stdin.buffer.read())\n"
              "print(f('<table class=\"infobox\"><tr><td>Political party <a>P</a></td></tr></table>')[5])\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], input=payload, capture_output=True, cwd=tmp_path,
                         env=env, timeout=120)
    assert out.returncode == 0, out.stderr.decode()[-500:]
    assert out.stdout.decode().strip() == "P"
