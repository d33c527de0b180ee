"""Weekly log files of the driver."""

from __future__ import annotations

import logging
import logging.handlers
from pathlib import Path


def configure(folder: str, level: str = "INFO") -> logging.Handler:
    """Log to ``folder``, a new file every Monday (UTC), all kept; earlier handlers are removed."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    handler = logging.handlers.TimedRotatingFileHandler(Path(folder) / "quire.log", when="W0", utc=True, backupCount=0, encoding="utf-8")
    handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
    root = logging.getLogger()
    for old in list(root.handlers):
        root.removeHandler(old)
    root.addHandler(handler)
    root.setLevel(level.upper())
    return handler
