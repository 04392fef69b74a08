"""DataFrame -> DataFrame operators. None of them creates a session or pulls
more than a scalar / bounded summary into the driver."""
