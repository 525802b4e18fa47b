"""Workflows (writer, reader) and the catalog of registered queries."""

from rivulet.plans import catalog  # noqa: F401
from rivulet.plans.reader import build_reader  # noqa: F401
from rivulet.plans.writer import build_stateful_writer, build_writer, stage_bounded  # noqa: F401
