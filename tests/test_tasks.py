import pytest

from obsforge import __main__ as cli
from obsforge.errors import MissingTable, RepeatedWarning, TaskFailed, UnknownQuery
from obsforge.tasks import task


def test_attempts():
    calls = []

    @task(attempts=3)
    def f(x):
        calls.append(x)
        if len(calls) < 3:
            raise ValueError("no")
        return x

    with pytest.warns(RepeatedWarning):
        assert f(4) == 4
    assert calls == [4, 4, 4] and f.plain(5) == 5

    @task(attempts=2)
    def g():
        raise ValueError("never")

    with pytest.warns(RepeatedWarning), pytest.raises(TaskFailed):
        g()
    with pytest.raises(ZeroDivisionError):
        task()(lambda: 1 / 0)()


def test_command_line(spark, sf, tmp_path, capsys):
    assert cli.main(["list"]) == 0 and "p7_found" in capsys.readouterr().out
    with pytest.raises(UnknownQuery):
        cli.main(["run", "no_such", "--data", sf])
    with pytest.raises(MissingTable):
        cli.main(["run", "p7_found", "--data", "/no/such"])
    assert cli.main(["run", "ready_files_filter", "--data", sf, "--out", str(tmp_path / "o"), "--format", "json"]) == 0
    assert spark.read.json(str(tmp_path / "o")).columns
    assert cli.main(["explain", "ready_files_filter", "--data", sf]) == 0 and "Physical Plan" in capsys.readouterr().out
