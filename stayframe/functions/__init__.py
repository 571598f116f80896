from stayframe.functions.expressions import *  # noqa: F401,F403
