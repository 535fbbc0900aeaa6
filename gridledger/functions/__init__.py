from gridledger.functions.rules import *  # noqa: F401,F403
