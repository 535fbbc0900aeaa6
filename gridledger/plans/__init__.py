from gridledger.plans.forecasting import forecast
from gridledger.plans.keyset import keys
from gridledger.plans.margins import master, net_predecessors

__all__ = ["forecast", "keys", "master", "net_predecessors"]
