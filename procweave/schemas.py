"""Column names and types of the record tables."""

from __future__ import annotations

#: A process: pids are used again, start times separate the uses.
PROCESS = ("host", "startTime", "pid")
#: Order of the observations of a process.
TIME = ("recTime", "recTimeUSec")
JOB = ("identifier", "subidentifier")

_CONTEXT = "host string, identifier string, subidentifier string, "
_TIMES = "recTime long, recTimeUSec long, startTime long, startTimeUSec long"
_MASK = "decimal(20,0)"

PROCSTAT_FIELDS: tuple[tuple[str, str], ...] = (
    ("pid", "long"), ("recTime", "long"), ("recTimeUSec", "long"), ("startTime", "long"), ("startTimeUSec", "long"), ("state", "string"), ("ppid", "long"), ("pgrp", "long"), ("session", "long"), ("tty", "long"), ("tpgid", "long"), ("flags", "long"), ("utime", "long"), ("stime", "long"), ("priority", "long"), ("nice", "long"), ("numThreads", "long"), ("vsize", "long"), ("rss", "long"), ("rsslim", _MASK), ("vmpeak", "long"), ("rsspeak", "long"), ("signal", _MASK), ("blocked", _MASK), ("sigignore", _MASK), ("sigcatch", _MASK), ("cpusAllowed", "long"), ("rtPriority", "long"), ("policy", "long"), ("guestTime", "long"), ("delayacctBlkIOTicks", "long"), ("io_rchar", "long"), ("io_wchar", "long"), ("io_syscr", "long"), ("io_syscw", "long"), ("io_readBytes", "long"), ("io_writeBytes", "long"), ("io_cancelledWriteBytes", "long"), ("m_size", "long"), ("m_resident", "long"), ("m_share", "long"), ("m_text", "long"), ("m_data", "long"), ("realUid", "long"), ("effUid", "long"), ("realGid", "long"), ("effGid", "long"),
)
PROCSTAT = _CONTEXT + ", ".join(f"{n} {t}" for n, t in PROCSTAT_FIELDS)
PROCDATA = f"{_CONTEXT}pid long, ppid long, {_TIMES}, execName string, cmdArgs string, exePath string, cwdPath string"
PROCFD = f"{_CONTEXT}pid long, ppid long, {_TIMES}, path string, fd long, mode long"
#: Job accounting: comma (4), colon (12) and comma (9 columns).
JOBS_4 = "job string, task string, user string, project string"
JOBS_12 = "user string, project string, job string, task string, hostname string, h_rt string, wall string, hvmem string, maxvmem string, ppn string, sge_status string, exit_status string"
JOBS_9 = "start long, end long, job long, task long, user string, project string, host string, cpu double, maxvmem double"
