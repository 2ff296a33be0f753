from skyroute.jobs import main

main()
