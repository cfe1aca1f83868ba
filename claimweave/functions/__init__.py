"""Column functions, all built from Spark expressions."""
from claimweave.functions.dates import *  # noqa: F401,F403
from claimweave.functions.identity import *  # noqa: F401,F403
from claimweave.functions.numbers import *  # noqa: F401,F403
from claimweave.functions.text import *  # noqa: F401,F403
