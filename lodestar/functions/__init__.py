"""Scalar functions (Column -> Column), all native Spark expressions."""

from lodestar.functions.text import *  # noqa: F401,F403
from lodestar.functions.dates import *  # noqa: F401,F403
from lodestar.functions.similarity import *  # noqa: F401,F403
from lodestar.functions.replies import *  # noqa: F401,F403
