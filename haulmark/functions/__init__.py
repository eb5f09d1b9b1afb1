"""Column functions. Every function takes and returns a Column and stays in the JVM."""

from haulmark.functions.dates import *  # noqa: F401,F403
from haulmark.functions.numbers import *  # noqa: F401,F403
from haulmark.functions.text import *  # noqa: F401,F403
