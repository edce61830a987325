"""What is decided on the driver before a plan is built: checks of requests, failures, paging."""
