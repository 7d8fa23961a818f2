from cohortspark.sources.readers import *  # noqa: F401,F403
from cohortspark.sources.tables import *  # noqa: F401,F403
from cohortspark.sources.writers import *  # noqa: F401,F403
