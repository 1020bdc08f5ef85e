import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_the_entry_point_imports_without_the_subpackage(folder):
    shutil.copytree(ROOT / "tidebars", f"{folder}/tidebars", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for keep_pipeline in (True, False):
        shutil.copy(ROOT / "__spark_entry__.py", folder)
        if keep_pipeline:
            shutil.copy(ROOT / "corpus_pipeline.py", folder)
        else:
            (pathlib.Path(folder) / "corpus_pipeline.py").unlink()
        code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q); assert not [n for n in q if n.startswith('op')]"
        subprocess.run([sys.executable, "-c", code], cwd=folder, check=True)
