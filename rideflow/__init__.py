"""rideflow: ride-hailing analytics on a Bronze -> Silver -> Gold lake, written for Spark."""
