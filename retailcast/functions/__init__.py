from retailcast.functions.columns import *  # noqa: F401,F403
from retailcast.functions.features import engineer  # noqa: F401
