"""What the driver's JVM has freed goes back to the system while a long job runs."""

import re
from pathlib import Path

import pytest

from millrace.llm import scratch


def test_tidy_returns_freed_native_memory(spark, monkeypatch):
    jvm = spark._jvm
    status = Path(f"/proc/{jvm.java.lang.ProcessHandle.current().pid()}/status")
    if not status.exists() or tuple(map(int, re.findall(r"\d+", jvm.System.getProperty("java.version"))[:3])) < (17, 0, 9):
        pytest.skip("the JVM cannot trim its native heap here")
    resident = lambda: int(re.search(r"VmRSS:\s+(\d+)", status.read_text())[1]) / 1024
    held = [jvm.java.util.zip.Deflater() for _ in range(1500)]  # each has its buffers outside the Java heap
    jvm.System.gc()
    full = resident()
    for x in held[:-1]:
        x.end()  # the last one keeps glibc from shrinking by itself
    monkeypatch.setattr(scratch, "_tidied", float("-inf"))
    scratch.tidy(spark)
    assert full - resident() > 70


def test_a_jvm_without_the_command_is_left_alone(spark, monkeypatch):
    class Without:
        def __getattr__(self, name):
            raise scratch.Py4JError("no such class")

    class Session:
        _jvm, sparkContext = Without(), spark.sparkContext

    monkeypatch.setattr(scratch, "_trims", True)
    scratch.trim_native(Session())
    assert not scratch._trims
    scratch.trim_native(None)
