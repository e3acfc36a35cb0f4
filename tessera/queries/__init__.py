"""The registered queries and the SQL that gives the same rows."""

from . import control, ground, pixels, records, shapes

QUERIES = control.Q | pixels.Q | ground.Q | records.Q | shapes.Q
ORACLE = control.SQL | pixels.SQL | ground.SQL | records.SQL | shapes.SQL
