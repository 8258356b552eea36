from clickseg.cli import main

main()
