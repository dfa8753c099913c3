"""Training-data operators over document tables; nothing else in the package imports this one."""
