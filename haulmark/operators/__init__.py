"""DataFrame-to-DataFrame operators."""

from haulmark.operators.changes import *  # noqa: F401,F403
from haulmark.operators.checks import *  # noqa: F401,F403
from haulmark.operators.headers import *  # noqa: F401,F403
from haulmark.operators.ranking import *  # noqa: F401,F403
from haulmark.operators.reshape import *  # noqa: F401,F403
