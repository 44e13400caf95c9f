"""The library's operators and jobs run on the driver's tables, with oracle SQL."""
