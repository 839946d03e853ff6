import subprocess
import sys

from pyspark import cloudpickle

from celltide.operators.matching import _match_city, _nearest_in_city, _serve_place


def test_task_functions_need_no_installation(tmp_path):
    """They load where the package cannot be found, as on an executor."""
    for i, fn in enumerate((_match_city, _nearest_in_city(3), _serve_place(1, 10))):
        (tmp_path / f"{i}.pkl").write_bytes(cloudpickle.dumps(fn))
    code = (
        "import importlib.util, pickle, sys\n"
        "assert importlib.util.find_spec('celltide') is None\n"
        "for i in range(3):\n"
        "    assert callable(pickle.load(open(f'{i}.pkl', 'rb')))\n"
    )
    # Isolated: neither the caller's PYTHONPATH nor the current folder may help.
    subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, check=True, timeout=120)
